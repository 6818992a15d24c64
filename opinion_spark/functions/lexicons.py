"""Word lists, phrases, thresholds and patterns used by the operators.

All values in this module are fixed values: they decide the results of the
scoring operators, so they are data, not tuning knobs. Every operator takes
them as a default argument and accepts another list.
"""

# ---- fixed values: review sentiment words -------------------------------
SENTIMENT_POSITIVE = [
    "delicious", "tasty", "fresh", "flavorful", "amazing", "excellent",
    "perfect", "love", "great", "wonderful", "satisfying",
]
SENTIMENT_NEGATIVE = [
    "stale", "bland", "awful", "terrible", "spoiled", "expired",
    "disgusting", "horrible", "tasteless", "disappointing", "inedible",
]

# ---- fixed values: words counted as drift features ----------------------
DRIFT_POSITIVE = ["delicious", "tasty", "fresh", "amazing", "perfect", "love", "excellent", "great"]
DRIFT_NEGATIVE = ["terrible", "awful", "stale", "bad", "horrible", "disgusting", "waste", "disappointed"]

# ---- fixed values: product aspects and the words that mention them ------
ASPECT_KEYWORDS = {
    "taste": ["taste", "tastes", "tasted", "tasty", "flavorful", "delicious", "yummy",
              "bland", "bitter", "sweet", "sour", "salty"],
    "flavor": ["flavor", "flavour", "flavored", "flavoring", "spicy", "mild", "rich",
               "bold", "subtle", "intense"],
    "quality": ["quality", "fresh", "stale", "expired", "premium", "cheap",
                "high-quality", "low-quality", "excellent", "poor"],
    "freshness": ["fresh", "freshness", "stale", "expired", "spoiled", "crisp", "soggy",
                  "moldy", "rotten"],
    "price": ["price", "cost", "expensive", "cheap", "value", "money", "dollar",
              "affordable", "overpriced", "budget"],
    "packaging": ["packaging", "package", "wrapped", "container", "box", "bag", "sealed",
                  "damaged", "broken", "secure"],
    "shipping": ["shipping", "delivery", "arrived", "fast", "slow", "quick", "delayed",
                 "prompt", "timely"],
    "texture": ["texture", "smooth", "rough", "creamy", "crunchy", "soft", "hard", "chewy",
                "tender", "tough"],
    "ingredients": ["ingredients", "natural", "organic", "artificial", "preservatives",
                    "additives", "pure", "healthy", "nutritious"],
    "value": ["value", "worth", "recommend", "satisfied", "happy", "disappointed",
              "good deal", "waste of money"],
}

# ---- fixed values: phrases that point to a fake review ------------------
GENERIC_PHRASES = [
    "great taste", "amazing flavor", "delicious food", "highly recommend",
    "fresh ingredients", "excellent quality", "love this product",
    "worth the money", "perfect snack", "good value", "tasty treat",
]
SPAM_PHRASES = [
    "buy now", "click here", "visit my", "check out",
    "follow me", "discount code", "free shipping", "limited time",
]
PUNCTUATION_RUNS = ["!!!", "???", "!!", "...", "***"]
COMPETITOR_PHRASES = [
    "better than", "compared to", "unlike other brands",
    "worst food", "dont buy", "terrible taste", "overpriced food",
    "much better brands", "competitor tastes better",
]
FOOD_SPAM_PHRASES = [
    "changed my life", "best food ever", "amazing amazing",
    "perfect perfect", "love love love", "yummy yummy",
    "so good so good", "fresh fresh fresh",
]

# ---- fixed values: phrases that make a scraped review invalid -----------
SCRAPE_SPAM = ["click here", "visit our website", "buy now", "limited time", "!!!!"]

# ---- fixed values: contractions, applied in this order, case-sensitive --
CONTRACTIONS = [
    ("don't", "do not"), ("won't", "will not"), ("can't", "cannot"),
    ("n't", " not"), ("'re", " are"), ("'ve", " have"),
    ("'ll", " will"), ("'d", " would"), ("'m", " am"),
]

# ---- fixed values: credential patterns (case-insensitive) ---------------
SECRET_PATTERNS = [
    ("api_keys", r"""api[_-]?key[s]?\s*[=:]\s*["'][^"']{10,}["']"""),
    ("api_keys", r"""secret[_-]?key[s]?\s*[=:]\s*["'][^"']{10,}["']"""),
    ("api_keys", r"""access[_-]?token[s]?\s*[=:]\s*["'][^"']{10,}["']"""),
    ("api_keys", r"""auth[_-]?token[s]?\s*[=:]\s*["'][^"']{10,}["']"""),
    ("passwords", r"""password[s]?\s*[=:]\s*["'][^"']{6,}["']"""),
    ("passwords", r"""passwd[s]?\s*[=:]\s*["'][^"']{6,}["']"""),
    ("passwords", r"""pwd[s]?\s*[=:]\s*["'][^"']{6,}["']"""),
    ("database_urls", r"""database[_-]?url[s]?\s*[=:]\s*["'][^"']*://[^"']+["']"""),
    ("database_urls", r"""db[_-]?url[s]?\s*[=:]\s*["'][^"']*://[^"']+["']"""),
    ("cloud_keys", r"""aws[_-]?access[_-]?key[_-]?id[s]?\s*[=:]\s*["'][^"']{16,}["']"""),
    ("cloud_keys", r"""aws[_-]?secret[_-]?access[_-]?key[s]?\s*[=:]\s*["'][^"']{32,}["']"""),
    ("cloud_keys", r"""google[_-]?api[_-]?key[s]?\s*[=:]\s*["'][^"']{32,}["']"""),
    ("openai_keys", r"""sk-[a-zA-Z0-9]{32,}"""),
    ("openai_keys", r"""openai[_-]?api[_-]?key[s]?\s*[=:]\s*["']sk-[^"']+["']"""),
]

# ---- fixed values: monitoring thresholds, alert rules, channels ---------
SYSTEM_THRESHOLDS = {"cpu_usage": 85.0, "memory_usage": 85.0, "disk_usage": 90.0}
ACCURACY_THRESHOLD = 0.7
CRITICAL_ABOVE = {"cpu_usage": 95.0, "memory_usage": 95.0, "disk_usage": 98.0}
RESPONSE_SECONDS = 1.0    # a database that answers within is healthy
LEAST_CONFIDENCE = 0.5    # a model that is surer of a test text is healthy
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}
# alert type -> (cooldown minutes, escalation minutes)
ALERT_RULES = {
    "system_threshold": (15, 60),
    "model_performance": (30, 120),
    "health_check": (10, 30),
}
DEFAULT_RULE = (15, 60)
# channel -> (enabled, severities it wants)
CHANNELS = {
    "console": (True, ["medium", "high", "critical"]),
    "log": (True, ["low", "medium", "high", "critical"]),
    "email": (False, ["high", "critical"]),
}

# ---- fixed values: weights of the recommendation methods ----------------
METHOD_WEIGHTS = {
    "user_based": 0.3, "item_based": 0.3, "matrix_factorization": 0.25,
    "content_based": 0.1, "popular": 0.05,
}

# ---- fixed values: source column -> standard column ---------------------
COLUMN_DIALECTS = {
    "ProductId": "product_id", "asin": "product_id",
    "UserId": "user_id", "reviewerID": "user_id",
    "Score": "rating", "overall": "rating",
    "Text": "review_text", "reviewText": "review_text",
    "Summary": "review_title", "summary": "review_title",
    "Time": "timestamp", "unixReviewTime": "timestamp",
    "HelpfulnessNumerator": "helpful_votes", "helpful": "helpful_votes",
    "HelpfulnessDenominator": "total_votes",
}
COPY_DIALECTS = {
    "asin": "product_id", "reviewerID": "user_id", "overall": "rating",
    "reviewText": "review_text", "summary": "review_title",
    "reviewTime": "review_date", "unixReviewTime": "review_timestamp",
}

# ---- fixed values: Spark's English stop words, but for those with an apostrophe, which no token holds ----
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now cannot could ought would
""".split()
