"""Column functions on text, HTML and URLs, and the few vectorised helpers behind them."""
