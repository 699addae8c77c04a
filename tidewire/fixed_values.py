"""Word lists, lookup tables and constants that decide results.

Everything in this file is data that has to be equal for results to be comparable. Order matters
where it says so. There is no logic here; `tidewire.config` bundles the values for the operators.
"""

# Feed registry. The position in this table is `feed_ord`, which decides which copy
# of an article survives the duplicate filter.
FEEDS = (
    ("coindesk", "https://www.coindesk.com/arc/outboundfeeds/rss/"),
    ("cointelegraph", "https://cointelegraph.com/rss"),
    ("decrypt", "https://decrypt.co/feed"),
    ("bitcoinist", "https://bitcoinist.com/feed/"),
    ("cryptoslate", "https://cryptoslate.com/feed/"),
    ("newsbtc", "https://www.newsbtc.com/feed/"),
    ("theblock", "https://www.theblock.co/rss.xml"),
    ("bitcoin_mag", "https://bitcoinmagazine.com/.rss/full/"),
    ("cryptopanic", "https://cryptopanic.com/news/rss/"),
    ("coinjournal", "https://coinjournal.net/feed/"),
    ("investing_crypto", "https://www.investing.com/rss/news_301.rss"),
    ("seeking_alpha", "https://seekingalpha.com/tag/cryptocurrency.xml"),
    ("marketwatch", "https://feeds.marketwatch.com/marketwatch/topstories/"),
    ("cnbc_crypto", "https://www.cnbc.com/id/10000664/device/rss/rss.html"),
    ("forbes_crypto", "https://www.forbes.com/crypto-blockchain/feed/"),
    ("messari", "https://messari.io/rss"),
    ("chainalysis", "https://blog.chainalysis.com/rss/"),
    ("elliptic", "https://www.elliptic.co/blog/rss.xml"),
    ("defiant", "https://thedefiant.io/feed"),
    ("coinmetrics", "https://coinmetrics.io/blog/rss/"),
    ("ark_invest", "https://ark-invest.com/feed/"),
    ("glassnode", "https://insights.glassnode.com/rss/"),
    ("santiment", "https://santiment.net/blog/feed"),
    ("binance_blog", "https://www.binance.com/en/blog/rss"),
    ("coinbase_blog", "https://blog.coinbase.com/feed"),
    ("kraken_blog", "https://blog.kraken.com/feed"),
    ("bitfinex_blog", "https://blog.bitfinex.com/feed/"),
    ("okx_blog", "https://www.okx.com/feed"),
    ("bybit_blog", "https://blog.bybit.com/en/feed/"),
    ("kucoin_blog", "https://www.kucoin.com/blog/rss"),
    ("ethereum_research", "https://ethresear.ch/latest.rss"),
    ("solana_blog", "https://solana.com/news/rss.xml"),
    ("polkadot_blog", "https://polkadot.network/blog/feed/"),
    ("chainlink_blog", "https://blog.chain.link/rss/"),
    ("crypto_news", "https://crypto.news/feed/"),
    ("ambcrypto", "https://ambcrypto.com/feed/"),
    ("beincrypto", "https://beincrypto.com/feed/"),
    ("coinspeaker", "https://www.coinspeaker.com/feed/"),
    ("blockchainreporter", "https://blockchainreporter.net/feed/"),
    ("cryptodaily", "https://cryptodaily.co.uk/feed"),
    ("dailycoin", "https://dailycoin.com/feed/"),
    ("coinmarketcap", "https://coinmarketcap.com/headlines/news/rss/"),
    ("coingecko_blog", "https://blog.coingecko.com/feed/"),
    ("sec_press_releases", "https://www.sec.gov/news/pressreleases.rss"),
    ("sec_litigation", "https://www.sec.gov/litigation/litreleases.rss"),
    ("cftc_news", "https://www.cftc.gov/PressRoom/PressReleases/rss"),
    ("eu_commission_finance", "https://ec.europa.eu/commission/presscorner/api/rss?language=en&filter=crypto"),
    ("bank_of_england", "https://www.bankofengland.co.uk/rss/news"),
    ("imf_blog", "https://www.imf.org/en/News/rss"),
    ("federal_reserve", "https://www.federalreserve.gov/feeds/press_all.xml"),
    ("blackrock_newsroom", "https://www.blackrock.com/us/individual/rss/press-releases"),
    ("fidelity_news", "https://www.fidelity.com/news/rss"),
    ("grayscale_news", "https://www.grayscale.com/rss.xml"),
    ("ark_etf_updates", "https://ark-funds.com/feed/"),
    ("vaneck_news", "https://www.vaneck.com/us/en/rss/"),
    ("cme_group", "https://www.cmegroup.com/rss/news.rss"),
    ("ice_markets", "https://ir.theice.com/rss/news-releases.xml"),
    ("coindesk_markets", "https://www.coindesk.com/arc/outboundfeeds/rss/category/markets/"),
    ("cert_usa", "https://www.cisa.gov/cybersecurity-advisories/all.xml"),
    ("mitre_attacks", "https://attack.mitre.org/resources/rss/"),
    ("rekt_news", "https://rekt.news/rss/"),
    ("hackernews_security", "https://feeds.feedburner.com/TheHackersNews"),
    ("ap_news_business", "https://apnews.com/rss/business"),
    ("ft_markets", "https://www.ft.com/?format=rss"),
    ("aave_blog", "https://aave.com/blog/rss.xml"),
    ("uniswap_blog", "https://blog.uniswap.org/rss.xml"),
    ("curve_blog", "https://curve.fi/blog/rss.xml"),
    ("defillama_blog", "https://defillama.com/blog/rss.xml"),
    ("l2beat_updates", "https://l2beat.com/rss.xml"),
    ("coinglass_blog", "https://www.coinglass.com/rss"),
    ("deribit_insights", "https://insights.deribit.com/feed/"),
)

# Credibility of a source; sources not listed get DEFAULT_SOURCE_WEIGHT.
SOURCE_WEIGHTS = {
    "sec_press_releases": 1.0,
    "sec_litigation": 1.0,
    "cftc_news": 1.0,
    "federal_reserve": 1.0,
    "imf_blog": 0.95,
    "bank_of_england": 0.95,
    "ft_markets": 0.95,
    "ap_news_business": 0.95,
    "al_jazeera_business": 0.90,
    "cnbc_crypto": 0.90,
    "marketwatch": 0.90,
    "chainalysis": 0.85,
    "glassnode": 0.85,
    "coinmetrics": 0.85,
    "messari": 0.85,
    "ark_invest": 0.85,
    "coinbase_blog": 0.80,
    "binance_blog": 0.80,
    "kraken_blog": 0.80,
    "okx_blog": 0.75,
    "bybit_blog": 0.75,
    "theblock": 0.75,
    "coindesk": 0.75,
    "bitcoin_mag": 0.70,
    "cointelegraph": 0.65,
    "decrypt": 0.65,
    "cryptoslate": 0.65,
    "newsbtc": 0.60,
    "cryptopanic": 0.50,
    "coinjournal": 0.55,
    "beincrypto": 0.50,
    "seeking_alpha": 0.60,
}
DEFAULT_SOURCE_WEIGHT = 0.60

# An article is relevant when its text contains at least one of these.
RELEVANCE_WORDS = (
    "bitcoin", "btc", "ethereum", "eth", "crypto", "blockchain", "defi", "nft", "token", "wallet",
    "exchange", "stablecoin", "coinbase", "binance", "kraken", "bybit", "okx", "fed", "cpi",
    "inflation", "interest rate", "tariff", "treasury", "dollar", "recession", "gdp", "liquidity",
    "sec", "cftc", "regulation", "etf", "halving",
)

# Asset label -> substrings, in label order.
ASSET_WORDS = {
    "BTC": ("bitcoin", "btc"),
    "ETH": ("ethereum", "eth"),
    "SOL": ("solana", "sol"),
    "XRP": ("xrp", "ripple"),
    "USDT": ("tether", "usdt"),
    "USDC": ("usdc",),
    "AAVE": ("aave",),
    "AVAX": ("avalanche", "avax"),
    "DEFI": ("defi", "decentralized finance"),
    "ETF": ("etf", "exchange traded fund"),
    "MARKET": ("fed", "cpi", "inflation", "rate cut", "dollar", "liquidity", "tariff", "treasury",
               "gdp", "recession"),
    "REGULATION": ("sec", "cftc", "attorney general", "lawsuit", "sues", "illegal", "ban", "damages",
                   "unlicensed", "enforcement"),
    "EXCHANGE": ("coinbase", "gemini", "binance", "kraken", "bybit", "okx", "kalshi", "hyperliquid"),
}

# Category fragment -> event type; the first fragment found wins.
CATEGORY_FRAGMENTS = (
    ("regulation", "regulation"),
    ("legal", "regulation"),
    ("enforcement", "regulation"),
    ("macro", "macro"),
    ("monetary", "macro"),
    ("hack", "hack"),
    ("exploit", "hack"),
    ("security", "hack"),
    ("institutional", "institutional"),
    ("adoption", "listing"),
    ("listing", "listing"),
    ("on-chain", "whale_move"),
    ("whale", "whale_move"),
    ("defi", "whale_move"),
    ("sentiment", "price_movement"),
    ("technical", "price_movement"),
)

# Keyword rules (event type, priority, smallest number of distinct keywords, keywords).
EVENT_RULES = (
    ("hack", 5, 1, ("hack", "hacked", "exploit", "exploited", "drained", "breach", "stolen", "siphon",
                    "vulnerability", "attack")),
    ("regulation", 5, 1, ("sec", "cftc", "regulation", "lawsuit", "ban", "approved", "etf", "filing",
                          "legislation", "compliance", "enforcement")),
    ("macro", 4, 2, ("fed", "cpi", "inflation", "interest rate", "recession", "gdp", "tariff",
                     "treasury", "dollar index", "rate cut", "rate hike")),
    ("institutional", 4, 1, ("firm", "trump-backed", "corporate", "treasury", "buys", "purchased",
                             "acquires", "holdings", "adds", "billion", "million", "institutional",
                             "strategy", "mstr", "microstrategy", "shares spike", "etf inflow", "fund",
                             "pre-ipo")),
    ("whale_move", 3, 1, ("whale", "on-chain", "accumulation", "dormant wallet", "large transfer",
                          "moved", "outflow", "inflow")),
    ("price_movement", 2, 2, ("surge", "rally", "pump", "dump", "crash", "plunge", "rebound", "jump",
                              "breakout", "resistance", "support", "ath")),
    ("listing", 2, 2, ("listed", "listing", "launches", "new token", "trading pair",
                       "exchange listing")),
)

# Event type -> timeframe and base impact.
TIMEFRAMES = {
    "hack": "short", "price_movement": "short", "whale_move": "short", "listing": "short",
    "institutional": "mid", "regulation": "mid", "macro": "mid", "unknown": "short",
}
DEFAULT_TIMEFRAME = "short"
IMPACT_BASE = {
    "hack": 3, "regulation": 3, "institutional": 3, "macro": 2, "whale_move": 2,
    "price_movement": 1, "listing": 1, "unknown": 0,
}
IMPACT_BOOST_ASSETS = ("BTC", "MARKET", "REGULATION")

# Limits and thresholds.
TITLE_CHARS = 500
CONTENT_CHARS = 5000
PROMPT_CONTENT_CHARS = 250
REASON_CHARS = 30
SCORED_CHARS = 400
SHORTEST_SCORED = 10
ENTRIES_PER_FEED = 50
STRONG_SOURCE = 0.85
WEAK_SOURCE = 0.55
POLARITY = 0.1
HEADLINE_SHARE = 0.4
CONTENT_SHARE = 0.6
CANDLE_ROWS = 100

# Macro tickers by output column, in order of preference.
MACRO_TICKERS = {
    "dxy": ("DX=F", "UUP"),
    "gold_price": ("GC=F",),
    "sp500_return_1d": ("^GSPC",),
    "us_10y_yield": ("^TNX",),
}

# Flag column -> event type, counter column -> event type, counter column -> asset.
EVENT_FLAGS = {
    "has_regulation": "regulation", "has_hack": "hack", "has_institutional": "institutional",
    "has_macro": "macro", "has_whale": "whale_move", "has_geopolitical": "geopolitical",
    "has_listing": "listing", "has_defi": "defi", "has_security": "security",
}
EVENT_COUNTS = {
    "regulation_count": "regulation", "hack_count": "hack", "institutional_count": "institutional",
    "macro_count": "macro",
}
ASSET_COUNTS = {
    "btc_mentions": "BTC", "eth_mentions": "ETH", "regulation_mentions": "REGULATION",
    "exchange_mentions": "EXCHANGE", "market_mentions": "MARKET", "defi_mentions": "DEFI",
    "etf_mentions": "ETF",
}
