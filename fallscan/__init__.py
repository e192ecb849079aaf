"""fallscan: finds sharp price drops in large collections of daily bars.

Every function takes and returns DataFrames, triggers no action, and works on
one long table keyed by ``(ticker, trade_date)``. There is no loop over tickers.
"""

__version__ = "0.1.0"
