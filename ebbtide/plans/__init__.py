"""End-to-end lists and the size-checked physical choices behind them."""
