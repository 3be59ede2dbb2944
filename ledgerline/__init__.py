"""ledgerline: Spark jobs for published economic and financial time series."""
