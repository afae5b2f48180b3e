"""Word lists and lookup tables.

FIXED VALUES — these lists must equal the ones the original projects used for
their results to match, so they are written out plainly and in natural order.
"""

# FIXED VALUES: ASCII punctuation (Python's string.punctuation, POSIX [:punct:]).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# FIXED VALUES: the English stop-word list of the public NLTK stopwords corpus
# (179 words), used by the cleaners.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what",
    "which", "who", "whom", "this", "that", "that'll", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "having",
    "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very",
    "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn",
    "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't",
    "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn",
    "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
)

# Small hand-written lemma table (token, part of speech, lemma). A full WordNet
# is not available offline; callers can pass their own (token, pos, lemma)
# DataFrame to the lemma join. Unknown tokens pass through unchanged.
LEMMAS = (
    ("loving", "v", "love"), ("loved", "v", "love"), ("loves", "v", "love"),
    ("tools", "v", "tool"), ("running", "v", "run"), ("ran", "v", "run"),
    ("runs", "v", "run"), ("makes", "v", "make"), ("made", "v", "make"),
    ("making", "v", "make"), ("learning", "v", "learn"), ("learned", "v", "learn"),
    ("learns", "v", "learn"), ("processing", "v", "process"),
    ("processed", "v", "process"), ("interesting", "v", "interest"),
    ("is", "v", "be"), ("are", "v", "be"), ("was", "v", "be"), ("were", "v", "be"),
    ("has", "v", "have"), ("had", "v", "have"), ("does", "v", "do"),
    ("did", "v", "do"), ("going", "v", "go"), ("went", "v", "go"),
    ("tools", "n", "tool"), ("models", "n", "model"), ("words", "n", "word"),
    ("emails", "n", "email"), ("offers", "n", "offer"), ("prices", "n", "price"),
    ("products", "n", "product"), ("customers", "n", "customer"),
    ("days", "n", "day"), ("movies", "n", "movie"), ("reviews", "n", "review"),
    ("news", "n", "news"), ("stories", "n", "story"), ("cities", "n", "city"),
    ("tickets", "n", "ticket"), ("meetings", "n", "meeting"),
    ("messages", "n", "message"), ("friends", "n", "friend"),
    ("services", "n", "service"), ("orders", "n", "order"), ("items", "n", "item"),
)

# FIXED VALUES: the chatbot's fallback city gazetteer, in its written order.
KNOWN_CITIES = (
    "karachi", "lahore", "islamabad", "multan", "faisalabad", "peshawar",
    "quetta", "rawalpindi", "london", "new york", "paris", "dubai",
    "tokyo", "delhi", "mumbai", "beijing", "moscow", "cairo", "toronto",
)

# FIXED VALUES: class names treated as the positive class of a binary task.
POSITIVE_LABEL_NAMES = ("spam", "fake", "positive", "1", "yes", "true")

# FIXED VALUES: interaction weights of the feed engine; other types weigh 1.0.
INTERACTION_WEIGHTS = {"view": 1.0, "click": 2.0, "like": 3.0, "search": 1.5}

# How the test ``events`` types play the feed's interaction types.
EVENT_TYPE_ROLES = {"view": "view", "click": "click", "purchase": "like", "signup": "search"}

# FIXED VALUES: A/B groups of the offline evaluation, (group, strategy, alpha).
AB_GROUPS = (
    ("A_content_only", "content", 1.0),
    ("B_collaborative_only", "collaborative", 0.0),
    ("C_hybrid", "hybrid", 0.5),
)
