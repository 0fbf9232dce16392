"""Vocabularies of the trading profile."""

from __future__ import annotations

# Codes, names and word lists that results depend on.
FOREX_CODES = ("USD", "EUR", "GBP", "JPY", "AUD", "NZD", "CAD", "CHF")
KNOWN_SYMBOLS = ("BTCUSD", "BTCUSDT", "ETHUSD", "ETHUSDT", "XAUUSD", "XAGUSD", "US30", "NAS100", "SPX500", "GER40", "UK100", "WTI", "BRENT")
VENUES = ("BINANCE", "BYBIT", "BITGET", "COINBASE", "KRAKEN", "OKX")
BASE_ALIASES = {"bitcoin": "BTC", "bitokn": "BTC", "btc": "BTC", "ethereum": "ETH", "ether": "ETH", "eth": "ETH", "gold": "XAU", "silver": "XAG", "nasdaq": "NAS100", "dow": "US30", "sp500": "SPX500"}
QUOTE_ALIASES = {"tether": "USDT", "tethers": "USDT", "tetherus": "USDT", "tetherusd": "USDT", "usdt": "USDT", "usd": "USD", "dollar": "USD", "dollars": "USD"}
DISPLAY_NAMES = {"BTCUSDT": "Bitcoin / TetherUS", "BTCUSD": "Bitcoin / US Dollar", "ETHUSDT": "Ethereum / TetherUS", "ETHUSD": "Ethereum / US Dollar", "XAUUSD": "Gold / US Dollar", "XAGUSD": "Silver / US Dollar"}
#: Canonical timeframe -> the words that name it.
TIMEFRAMES = {
    "M1": ("1m", "m1"), "M3": ("3m",), "M5": ("5m", "m5"), "M15": ("15m", "m15", "1s"), "M30": ("30m", "m30"), "M45": ("45m",),
    "H1": ("1h", "h1", "ih", "lh"), "H2": ("2h",), "H4": ("4h", "h4"), "H6": ("6h",), "H8": ("8h",), "H12": ("12h",),
    "D1": ("1d", "d1"), "W1": ("1w", "w1"), "MN1": ("1mo",),
}
#: Canonical timeframe -> the one spelling besides its code that a picture's text may show it by.
FRAME_NAMES = {k: (v[0],) for k, v in TIMEFRAMES.items()}
#: Asset type -> the element tag it stands for.
PANELS = {"chart": "chart_panel", "performance_panel": "performance_panel", "strategy_figure": "strategy_panel", "figure": "generic_figure"}
LEVEL_WORDS = ("entry", "stop", "tp", "target")
METRIC_WORDS = ("pnl", "drawdown", "win rate", "profit factor", "sharpe")
RULE_WORDS = ("strategy", "rules", "checklist", "criteria")
CONCEPTS = {
    "breakout": ("breakout", "range break", "compression break"),
    "pullback": ("pullback", "retest", "retracement"),
    "trend_following": ("trend", "trendline", "trend following"),
    "mean_reversion": ("mean reversion", "reversion", "overextended"),
    "market_structure": ("higher high", "lower low", "bos", "choch", "market structure"),
    "support_resistance": ("support", "resistance", "s/r", "level"),
    "risk_management": ("risk", "risk management", "position size", "risk reward", "risk/reward", "r:r", "r/r"),
    "stop_loss": ("stop loss", "sl", "stop"),
    "take_profit": ("take profit", "tp", "target"),
    "liquidity": ("liquidity", "sweep", "stop hunt"),
    "order_flow": ("order flow", "footprint", "delta", "bid ask"),
    "volume": ("volume", "vpvr", "volume profile"),
    "divergence": ("divergence", "hidden divergence"),
    "reversal": ("reversal", "fade", "turnaround"),
    "range": ("range", "sideways", "consolidation"),
    "volatility": ("volatility", "atr", "expansion", "compression"),
    "momentum": ("momentum", "impulse", "acceleration"),
    "psychology": ("discipline", "psychology", "emotion", "mindset"),
}
DOMAINS = {
    "technical_analysis": ("candlestick", "support", "resistance", "breakout", "trendline", "chart", "pattern"),
    "risk_management": ("risk", "drawdown", "stop loss", "position size", "exposure"),
    "performance_review": ("pnl", "profit factor", "win rate", "equity curve", "drawdown", "sharpe"),
    "execution": ("entry", "exit", "limit order", "market order", "execution", "fill"),
    "macro_context": ("cpi", "fomc", "rates", "macro", "news", "fed", "ecb"),
    "trading_psychology": ("discipline", "emotion", "mindset", "patience", "fear", "greed"),
}
#: Page types in order (ties go to the first) -> words that each count two.
PAGE_TYPES = {
    "chart": ("chart", "candlestick", "support", "resistance", "trendline", "breakout"),
    "trade_journal": ("entry", "exit", "stop loss", "take profit", "trade review", "journal"),
    "performance_report": ("pnl", "drawdown", "win rate", "profit factor", "sharpe", "equity"),
    "strategy_note": ("strategy", "rules", "playbook", "checklist", "setup criteria"),
    "market_analysis": ("analysis", "bias", "outlook", "scenario", "session plan"),
    "educational_note": ("definition", "example", "lesson", "tutorial", "explained"),
}
CHART_WORDS = ("chart", "candlestick", "trendline", "entry", "stop loss", "take profit")
PANEL_WORDS = ("equity curve", "drawdown", "win rate", "profit factor", "sharpe", "pnl")
STRATEGY_WORDS = ("strategy", "rules", "checklist", "playbook")
RECORD_FIELDS = {
    "symbol": ("symbol", "ticker", "asset", "instrument", "market"),
    "timeframe": ("timeframe", "tf", "interval"),
    "direction": ("direction", "side", "bias", "action", "signal"),
    "entry": ("entry", "entry_price", "buy_price", "sell_price", "open_price"),
    "stop_loss": ("stop_loss", "sl", "stop"),
    "take_profit": ("take_profit", "tp", "target", "target_price"),
    "thesis": ("thesis", "reason", "rationale", "setup", "setup_reason"),
    "notes": ("notes", "comment", "comments", "summary", "description"),
    "outcome": ("outcome", "result", "status"),
    "pnl": ("pnl", "profit", "profit_loss", "return", "return_pct", "roi"),
    "start_time": ("start_time", "open_time", "entry_time", "timestamp", "date"),
    "end_time": ("end_time", "close_time", "exit_time"),
}
PASSED_FIELDS = ("strategy", "session", "exchange", "broker")
NO_SETUP = (r"\bkein\s+setup\b", r"\bkeine[sr]?\s+setup\b", r"\bno\s+setup\b", r"\bwithout\s+setup\b", r"\bohne\s+setup\b", r"\bkein\s+signal\b")
NUMBER = r"([0-9]+(?:[.,][0-9]+)*)"
LEVELS = {"entry": (r"\bentry(?:\s*price)?\b[:\s-]*",), "stop_loss": (r"\bstop(?:\s*loss)?\b[:\s-]*", r"\bsl\b[:\s-]*"), "take_profit": (r"\btake\s*profit\b[:\s-]*", r"\btp\b[:\s-]*", r"\btarget\b[:\s-]*")}
WEEKDAYS = ("montag", "dienstag", "mittwoch", "donnerstag", "freitag", "samstag", "sonntag")
MOJIBAKE = ("�", "Ã", "Â", "â€", "â€“", "â€”", "â€œ", "â€\x9d", "â€™", "ï¿½", "â\u0080")
ARTIFACTS = ("\ufffd", "Ã", "Â", "â€", "ï¿½")
PUNCTUATION = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "−": "-", "…": "...", " ": " "}
EXTENSIONS = {"jpg": "jpg", "jpeg": "jpg", "png": "png", "webp": "webp", "bmp": "bmp", "tif": "tif", "tiff": "tif"}
UPLOAD_MARKERS = (
    "attachment_preview_missing", "image upload did not appear", "could not upload image attachments to chatgpt", "file upload is not available", "file uploads are not available",
    "file uploads are currently unavailable", "uploads are not available", "uploads are currently unavailable", "upload limit", "usage limit",
)
QUALITY_RANKS = {"low": 0, "medium": 1, "high": 2}
