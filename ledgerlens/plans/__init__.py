"""Query registry (``registry``), DuckDB oracle statements (``oracle``) and
physical-plan checks (``checks``)."""
