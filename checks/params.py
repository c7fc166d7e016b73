"""Parameters that the bound queries and their SQL counterparts share."""

from galewatch.operators.sentiment import Rules

# A lexicon and modifier words that occur in the invented prose of the test
# tables, so that every scoring rule acts on whole documents. Two words are in
# the lexicon and a modifier list: before other words they act as neither.
LEXICON = (("the", 1.5), ("of", -1.2), ("and", 0.4), ("der", -0.8), ("la", 0.6), ("with", -2.1), ("les", 1.1), ("que", 0.7), ("to", -0.3))
RULES = Rules(
    intensifiers=("in", "que"),
    dampeners=("a", "en"),
    dampening_phrases=("for the", "es un"),
    negations=("to", "is", "le"),
    idioms={"of the": 2.5, "in the": -1.5, "de la": -2.0},
    contrast="that",
)
STATES = ("AFRICA", "ASIA")
PLACES = {"fr": "Paris, FR", "de": "Berlin,DE", "en": "London, EN, UK"}  # of languages; others have none or no comma
PLACED = ("FR", "DE")
LONG_TEXT = 1500
FEATURES = ("n_chars", "quality", "toxic")
BUCKETS = 8  # of the tables landed for the join; a bucket should fit a task
