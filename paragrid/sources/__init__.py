"""Readers of XML, ZIP, HTML, JSON and Markdown sources, and the parsers behind them."""
