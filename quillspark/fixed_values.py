"""Fixed values.

Word lists, patterns, thresholds and prompt wording that results depend on.
They are data, not logic: change one and the answers change.
"""

# --- text cleaning -------------------------------------------------------------

CLEAN_MIN_CHARS = 50
CLEAN_MAX_CHARS = 5000
KEPT_PUNCTUATION = ".,;:!?-()"

# --- record filters ------------------------------------------------------------

MIN_RECORD_CHARS = 200
MIN_SAMPLE_CHARS = 100
MIN_GENERATION_CHARS = 50
MIN_SCORABLE_CHARS = 10
TARGET_TOTAL = 50_000

# --- generation settings -------------------------------------------------------

LENGTH_TOLERANCE = 0.3
CHARS_PER_WORD = 5
TOKENS_PER_CHAR = 1.5
MAX_TOKENS = 1000
TOPIC_THRESHOLD = 0.2
MIN_GENERATED_CHARS = 30
MAX_GENERATED_CHARS = 8000
PASS_SHARE = 0.8
REQUIRED_CHECKS = ("not_empty", "no_prompt_leakage")

# provider -> (priority, requests per minute); target share where balanced
PROVIDER_LIMITS = {
    "groq": (1, 30),
    "firework": (2, 20),
    "openrouter": (3, 10),
    "cohere": (4, 15),
    "huggingface": (5, 20),
}
# provider -> requests per day
PROVIDER_DAILY_LIMITS = {
    "groq": 14400,
    "firework": 1000,
    "openrouter": 200,
    "cohere": 1000,
    "huggingface": 1000,
}
PROVIDER_TARGETS = {"groq": 0.70, "firework": 0.20, "openrouter": 0.10}
SHARE_TOLERANCE = 0.05
REBALANCE_THRESHOLD = 0.10

# --- generated-text cleaning: patterns in the order they apply -----------------
# {S} is the whitespace class, {L} "rest of the line".

GENERATED_NOISE = (
    r"^(rewritten abstract:|alternative version:|new abstract:|here is|below is|here's|this is a"
    r"|this abstract|the following|below you will find){S}*",
    r"\[ai-generated{L}?\]",
    r"\(generated by{L}?\)",
    r"note: this is{L}",
    r"---+{S}*$",
    r"###+{S}*$",
    r"##+{S}*$",
    r"# abstract:",
    r"# rewritten:",
    r"abstract:",
    r"summary:",
    r"version:",
    r"alternative:",
    r"as an ai{L}",
    r"i cannot{L}",
    r"let me{L}",
    r"let's{L}",
)

# --- quality checks ------------------------------------------------------------

LEAKAGE_PHRASES = (
    "rewritten abstract:", "alternative version:", "new abstract:", "here is", "below is",
    "as an ai", "i cannot", "[ai-generated", "(generated by", "note: this is", "---", "###", "##",
    "# abstract:", "# rewritten:", "abstract:", "summary:", "version:", "alternative:", "here's",
    "here is the", "this is a", "this abstract", "the following", "below you will find",
)
FIRST_PERSON = ("i", "we", "my", "our", "me", "us")
FIRST_PERSON_SHARE = 0.05
INFORMAL_WORDS = (
    "awesome", "cool", "amazing", "great", "nice", "good", "bad", "terrible", "wow", "yeah", "ok",
    "okay", "sure", "definitely", "totally", "really", "very", "so", "quite", "pretty",
)
INFORMAL_LIMIT = 3
CONVERSATIONAL = (
    "you can", "you will", "you should", "let me", "let's", "i think", "i believe",
    "in my opinion", "as you can see", "as we know",
)
DISTINCT_SENTENCE_SHARE = 0.8
REPEATED_BIGRAM_SHARE = 0.1
REPETITION_MIN_WORDS = 10

# --- keyword stop lists --------------------------------------------------------

CHECK_STOP_WORDS = (
    "this", "that", "with", "from", "they", "have", "been", "will", "were", "said", "using",
    "approach", "method", "study", "research", "paper", "work", "results", "analysis", "data",
)
PROMPT_STOP_WORDS = (
    "this", "that", "with", "from", "they", "have", "been", "will", "were", "said", "using",
    "approach", "method", "study", "research", "paper", "work", "results", "analysis", "data",
    "based", "show", "propose", "present", "demonstrate", "investigate", "examine", "explore",
    "develop", "design", "implement", "evaluate", "compare", "consider", "provide", "include",
    "contain", "different", "various", "several", "multiple", "numerous", "important",
    "significant", "effective", "efficient", "successful", "novel", "new", "recent", "current",
    "existing", "previous", "future",
)
KEYWORD_MIN_CHARS = 4
DEFAULT_KEYWORDS = "machine learning, artificial intelligence"
DEFAULT_CATEGORY = "General"

# --- Spark's own English stop-word list (StopWordsRemover) ---------------------

ENGLISH_STOP_WORDS = tuple(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom this
    that these those am is are was were be been being have has had having do does did doing a an
    the and but if or because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under again further then
    once here there when where why how all any both each few more most other some such no nor not
    only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll
    they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
    wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
    there's what's when's where's who's why's would""".split()
)

# --- rewrite groups: (old, new) substring replacements -------------------------

BASIC_REWRITES = (
    (("we", "the researchers"), ("our", "their")),
    (("this paper", "this study"), ("shows", "demonstrates")),
    (("method", "approach"), ("results", "findings")),
    (("analysis", "examination"), ("technique", "methodology")),
)
FULL_REWRITES = (
    (("we", "the researchers"), ("our", "their"), ("We", "The researchers")),
    (("this paper", "this study"), ("This paper", "This study")),
    (("shows", "demonstrates"), ("find", "discover"), ("found", "discovered")),
    (("method", "approach"), ("technique", "methodology")),
    (("results", "findings"), ("analysis", "examination")),
    (("propose", "present"), ("novel", "new"), ("state-of-the-art", "advanced")),
    (("performance", "effectiveness"), ("accuracy", "precision")),
    (("dataset", "data collection"), ("experiment", "investigation")),
)
SWAP_SHARE = 0.3
TRUNCATE_SHARE = 0.2

# --- prompt wording ------------------------------------------------------------

PROMPT_TEMPLATES = {
    "template_a": (
        "Rewrite this scientific abstract using different academic language while maintaining the "
        "same topic and approximate length ({min_length}-{max_length} characters):\n\n"
        "Title: {title}\nDomain: {categories}\nOriginal Abstract: {text}\n\nRewritten Abstract:\n"
    ),
    "template_b": (
        "Create an alternative version of this scientific abstract. Keep the same research topic "
        "and maintain similar length ({min_length}-{max_length} characters):\n\n"
        "Title: {title}\nDomain: {categories}\nOriginal: {text}\n\nAlternative Version:\n"
    ),
    "template_c": (
        "Generate a new version of this scientific abstract using different wording but the same "
        "research focus. Target length: {min_length}-{max_length} characters.\n\n"
        "Title: {title}\nDomain: {categories}\nReference: {text}\n\nNew Abstract:\n"
    ),
    "template_d": (
        "Write a scientific abstract about: {title}\nField: {categories}\n"
        "Target length: approximately {target_length} words\n"
        "Focus on: methodology, findings, and contributions\n"
    ),
    "template_e": (
        "Write an academic abstract incorporating these concepts:\n{keywords}\n"
        "Domain: {categories}\nLength: {target_length} words\nStyle: technical and formal\n"
    ),
    "template_f": (
        "Discuss research on {title} in the field of {categories}.\n"
        "Focus on methodologies, findings, and implications.\n"
        "Length: approximately {target_length} words\n"
    ),
    "template_g": (
        "What are the key contributions of research on {title}?\n"
        "Provide a technical summary focusing on methods and results.\n"
        "Domain: {categories}\nLength: {target_length} words\n"
    ),
}

# --- result bands --------------------------------------------------------------

CONFIDENCE_BANDS = ((0.9, "Very High"), (0.8, "High"), (0.7, "Moderate"))
LOWEST_BAND = "Low"
GRADES = ((0.85, "PROCEED"), (0.75, "IMPROVE"))
LOWEST_GRADE = "REDESIGN"
MODEL_FALLBACK_ORDER = ("SVM", "Random_Forest", "Naive_Bayes", "Logistic_Regression")

# --- design targets ------------------------------------------------------------

DOMAIN_SHARES = (0.25, 0.25, 0.25, 0.15, 0.10)
ROBUST_DROP = 0.05
OVERFIT_DROP = 0.10
ALERT_ACCURACY = 0.85
FLAG_THRESHOLD = 0.9
