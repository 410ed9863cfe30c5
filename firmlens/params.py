"""Settings of a run. Every value is passed explicitly; nothing is read from module state."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: names, words and sizes that results depend on --------------------------

# Event flags in the order they are asked for; "shutdown" never counts into the total.
SIGNALS = (
    "sector_change", "hq_change", "ma_spinoff", "renaming",
    "operational_change", "shutdown", "bankruptcy",
)
COUNTED_SIGNALS = tuple(s for s in SIGNALS if s != "shutdown")

# Detail column and summary label of each counted flag, in summary order.
DETAIL_COLUMNS = {
    "sector_change": ("sector_detail", "sector"),
    "hq_change": ("hq_detail", "hq"),
    "ma_spinoff": ("ma_detail", "M&A"),
    "renaming": ("rename_detail", "rename"),
    "operational_change": ("ops_detail", "ops"),
    "bankruptcy": ("bankruptcy_detail", "bankruptcy"),
}

USA_REGIONS = (
    "USA West", "USA New York", "USA Midwest", "USA South", "USA Boston", "USA Northeast",
)

# Root patterns of the keyword gate.
SIGNAL_ROOTS = (
    r"merger", r"merging", r"merged", r"acqui", r"takeover", r"spinoff", r"spin-off",
    r"divest", r"buyout", r"buy.?out",
    r"relocat", r"redomicil", r"headquarter", r"moved? (to|its)", r"new hq",
    r"renam", r"rebrand", r"new name", r"formerly known", r"changes? (its )?name",
    r"pivot", r"shifts? (to|into|focus)", r"transforms?", r"new (business|strategy|direction)",
    r"shutdown", r"shut.?down", r"clos(ing|ed|es|ure)", r"wind(ing)?.?down", r"dissolv",
    r"exit", r"layoff", r"lay.?off", r"redundanc", r"restructur", r"workforce reduction",
    r"bankrupt", r"chapter.?1[13]", r"insolvenc", r"liquidat", r"administration",
    r"receivership",
)

# Any-of words of the news searches.
NEWS_WORDS = (
    "merger", "acquisition", "bankruptcy", "shutdown", "restructuring", "rebranding",
    "renamed", "relocated", "rebranded", "spinoff", "redomicile", "headquarters", "new name",
)

# Feeds that are searched within the date horizon, and the only form type taken from the filings.
HORIZON_FEEDS = ("edgar", "google_news", "gdelt", "guardian")
FILING_FORM = "8-K"

SUMMARY_SHORT_CONTEXT = "Insufficient context to classify."
SUMMARY_NOTHING = "No significant corporate changes identified."
SUMMARY_UNCONFIRMED = "Signals detected but none confirmed after extraction."
SUMMARY_UNVERIFIED = "No significant corporate changes identified after verification."
SUMMARY_SKIPPED = "[skipped — not found in checkpoint]"
REASON_NO_CONTENT = "No headlines returned from free sources"
REASON_NO_KEYWORD = "No signal keywords near company name"
REASON_PARSE_ERROR = "parse error — defaulting to pass"
EMPTY_VIEW_TEXT = "No signals detected."


@dataclass(frozen=True)
class Source:
    """One feed: its place in the priority order and how its items are counted.

    page       items the feed hands over per query (raw items, before any dedupe); None = all
    cap        items kept per company after dedupe; None = bounded by `page` alone
    overrun    the cap is tested after an item is added, once per query, so each further
               query may still add one item
    skip_empty items without a URL are dropped
    checks     items whose URL an earlier source kept are dropped
    marks_all  every URL handed over counts as seen for later sources, kept or not
    at_sentence  where snippets are cut at sentence ends, this source's are too
    """

    name: str
    rank: int
    tag: str
    header: str
    page: int | None
    cap: int | None
    queries: int = 1
    overrun: bool = False
    skip_empty: bool = True
    checks: bool = True
    marks_all: bool = False
    snippet_chars: int | None = 400
    at_sentence: bool = True


# Feeds in priority order (the single-stage path).
SOURCES = (
    Source("edgar", 1, "SEC EDGAR", "SEC EDGAR", 5, None, skip_empty=False, checks=False,
           snippet_chars=None),
    Source("google_news", 2, "GOOGLE NEWS", "GOOGLE NEWS", None, 12, queries=2, overrun=True),
    Source("gdelt", 3, "GDELT", "GDELT NEWS", None, 10, snippet_chars=0),
    Source("guardian", 4, "GUARDIAN", "THE GUARDIAN", 5, None),
    Source("prnewswire", 5, "PR NEWSWIRE", "PR NEWSWIRE", None, 4, skip_empty=False),
    Source("businesswire", 6, "BUSINESS WIRE", "BUSINESS WIRE", None, 4, skip_empty=False),
    Source("wikipedia", 7, "WIKIPEDIA", "WIKIPEDIA", None, 1, skip_empty=False,
           snippet_chars=1200, at_sentence=False),
    Source("brave", 8, "BRAVE WEB", "BRAVE", None, 8, marks_all=True, snippet_chars=500),
    Source("tavily", 9, "TAVILY", "TAVILY DEEP SEARCH", 5, None, queries=5, snippet_chars=800),
)

# The cached two-stage path differs in three feeds: six filings that are checked against
# URLs already kept, a hard stop at twelve news items, and shorter deep-search snippets.
LAYERED_SOURCES = tuple(
    {
        "edgar": Source("edgar", 1, "SEC EDGAR", "SEC EDGAR", 6, None, skip_empty=False,
                        snippet_chars=None),
        "google_news": Source("google_news", 2, "GOOGLE NEWS", "GOOGLE NEWS", None, 12,
                              queries=2),
        "tavily": Source("tavily", 9, "TAVILY", "TAVILY DEEP SEARCH", 5, None, queries=5,
                         snippet_chars=700),
    }.get(s.name, s)
    for s in SOURCES
)

# ---- end of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    horizon_months: int = 12
    min_confidence: int = 2
    min_prescreen_score: int = 3
    # Characters of a headline text that the scorer reads; None for all of it.
    screen_chars: int | None = 2000
    chunk_chars: int = 3000
    max_chunks: int = 5
    chunk_overlap: int = 200
    max_sources: int = 15
    headline_min_chars: int = 50
    context_min_chars: int = 80
    encyclopedia_min_chars: int = 50
    cache_ttl_hours: int = 168
    cache_probe: int = 0  # up to so many asked keys are pushed into the cache's scan
    export_limit: int = 5000
    error_sample: int = 20
    error_chars: int = 500
    deep_queries: int = 5
    quota_warning: int = 800
    num_partitions: int = 200
    three_pass: bool = True
    # Faithful-to-the-letter switches; the defaults repair what is plainly an oversight.
    compat: bool = False
    deep_reserve_chars: int = 5000
    roots: tuple[str, ...] = SIGNAL_ROOTS
    sources: tuple[Source, ...] = field(default=SOURCES)

    @property
    def max_context_chars(self) -> int:
        return self.chunk_chars * self.max_chunks
