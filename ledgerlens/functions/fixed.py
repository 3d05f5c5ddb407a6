"""Fixed values.

Labels, default thresholds and formats that must equal those of the surveyed
statements for identical results, listed in statement order (01.1 .. 08.8).
Operators take the thresholds as parameters with these defaults.
"""

# --- fixed values (do not change) -------------------------------------------

# 01 sales performance
TOP_PRODUCTS = 1                      # 01.2 top 1
TOP_CUSTOMERS = 10                    # 01.3 top 10
TILES = 5                             # 01.7, 07.5, 07.6, 08.8 NTILE(5)
PERCENT_SUFFIX = "%"                  # 01.7 'NN.NN%'

# 02 customers
LAPSE_MONTHS = 12                     # 02.3 no order in the last 12 months
SEGMENT_STORE = "Store"               # 02.5, 02.6 segments
SEGMENT_INDIVIDUAL = "Individual"
SEGMENT_UNKNOWN = "Unknown"
DAYS_PER_YEAR = 360                   # 02.6 customer lifetime in years
TOP_REPEAT_CUSTOMERS = 10             # 02.7 top 10
REPEAT_MIN_ORDERS_EXCLUSIVE = 1       # 02.7 more than 1 order
STREAK_MIN_MONTHS = 5                 # 02.8 at least 5 consecutive months

# 03 products and inventory
LOW_SELLER_MAX_UNITS = 50             # 03.3 fewer than 50 units sold
DISCONTINUE_MAX_UNITS = 100           # 03.7 units < 100 and profit < 1000
DISCONTINUE_MAX_PROFIT = 1000
PROMOTE_MIN_UNITS = 200               # 03.7 units > 200 and profit > 2000
PROMOTE_MIN_PROFIT = 2000
RECOMMEND_DISCONTINUE = "ConsiderDiscontinuing"
RECOMMEND_PROMOTE = "Promote/InvestMore"
RECOMMEND_MONITOR = "Monitor"

# 05 profitability
HIGH_REVENUE_MIN = 10_000_000         # 05.6 revenue > 10 M
LOW_PROFIT_MAX = 5_000_000            # 05.6 profit < 5 M

# 07 advanced analytics
CHURN_R_SCORE = 2                     # 07.6 R_score = 2
PARETO_CUTOFF = "0.8"                 # 07.7, 07.8 cumulative share <= 0.8
ROLLING_MONTHS = 3                    # 07.9, 07.10 current + 2 preceding rows
DROP_BELOW = "0.8"                    # 07.10 < 0.8 x rolling mean
SPIKE_ABOVE = "1.2"                   # 07.10 > 1.2 x rolling mean
STATUS_DROP = "Sudden Drop"
STATUS_SPIKE = "Spike"
STATUS_NORMAL = "Normal"

# 08 executive
PRIORITY_PRODUCTS = 5                 # 08.1 top 5
LOYALTY_CUSTOMERS = 5                 # 08.2 top 5
LOYALTY_MIN_ORDERS = 5                # 08.2 at least 5 orders
LOSS_MIN_LINES = 5000                 # 08.3 more than 5000 lines
LOSS_MAX_PROFIT = 0                   # 08.3 profit < 0
OVERSTOCK_MAX_UNITS = 50              # 08.5 units < 50
OVERSTOCK_MIN_STOCK = 1000            # 08.5 stock > 1000
MARKUP_MAX = "0.3"                    # 08.7 markup < 0.3
MARKUP_MIN_LINES = 100                # 08.7 more than 100 lines
