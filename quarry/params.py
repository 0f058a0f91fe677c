"""Default parameters of the answering and evaluation policy.

Fixed values: these thresholds and sizes must equal the reference's defaults
for results to match; every operator takes them as keyword arguments so that
callers (and the driver-data queries) can pass their own.
"""

# --- fixed values (reference defaults) ---------------------------------------
CHUNK_SIZE = 800                 # greedy packing limit / fixed chunk size
CHUNK_OVERLAP = 150              # overlap of fixed-size chunks
MIN_ARTICLE_CHARS = 20           # article bodies of <= this length are dropped
MIN_PREAMBLE_CHARS = 100         # preamble kept when longer than this
MIN_CASE_FACT_CHARS = 50         # raw case facts shorter than this are dropped
CASE_LIMIT = 100_000             # the reference's number of case records read; opt-in here
RETRIEVAL_TOP_K = 8              # documents in an answer
SIMILARITY_THRESHOLD = 0.3       # similarity floor (declared, unused by default)
STATUTE_BOOST = 1.5              # statute weight (declared, unused by default)
MIN_RELEVANCE = 0.65             # low-relevance gate on mean statute relevance
CONFIDENCE_THRESHOLD = 0.35      # uncertain below this
RERANK_TOP_K = 3                 # documents kept after judge rerank
RERANK_THRESHOLD = 0.4           # judge score floor for "relevant"
RERANK_MAX_DOCS = 10             # judge sees at most this many candidates
RERANK_POOL = 5                  # the answer policy sends only the first 5
RERANK_MIN_DOCS = 3              # rerank only when more docs than this
MAX_EXPANSIONS = 3               # expanded queries used in parallel mode
MAX_HISTORY_TURNS = 15           # conversation turns kept
HISTORY_TEXT_TURNS = 3           # turns rendered into the prompt text
HISTORY_USER_CHARS = 200
HISTORY_ASSISTANT_CHARS = 300
CITATION_CHARS = 200
CITATION_PREVIEW_CHARS = 150
DEFAULT_CITATION_SCORE = 0.7
SCOPE_VERDICT_MIN_CONFIDENCE = 0.7
OUT_OF_SCOPE_CONFIDENCE = 0.1
LOW_RELEVANCE_CONFIDENCE = 0.2
CONFIDENCE_CAP = 0.95
BAND_HIGH = 0.7
BAND_MEDIUM = 0.4
HALLUCINATION_TIMEOUT_S = 5.0
CACHE_TTL_SECONDS = 7200
EMBED_BATCH_SIZE = 20
EMBED_RPM = 1000
EMBED_TPM = 50_000
EMBED_MIN_SLEEP_S = 0.1
EMBED_MAX_RETRIES = 5
EMBED_BACKOFF_S = 10.0
EMBED_BACKOFF_MAX_S = 120.0
LLM_RPM = 1000
LONG_ANSWER_CHARS = 1000         # local hallucination rule 4
CONTEXT_DOCS_LOCAL = 3           # local check reads the first 3 docs ...
CONTEXT_CHARS_LOCAL = 300        # ... 300 chars each
EVAL_REFUSAL_MIN_CHARS = 100     # evaluation hallucination: long answer without docs

# --- engine sizing (ours) -----------------------------------------------------
# kNN: bytes of the query vectors that a task holds, and corpus rows it compares them with.
KNN_BLOCK_BYTES = 64 * 1024 * 1024
KNN_PART_ROWS = 131_072
