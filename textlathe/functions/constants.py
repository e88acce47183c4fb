"""Fixed values that results depend on.

Word lists and tokens below are stated as plain text, in their natural order.
Larger tables (the whitespace set, the accent-folding pairs) are built from a
rule at import time instead of being listed.
"""

from __future__ import annotations

import unicodedata

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original behaviour for identical results)
# ---------------------------------------------------------------------------

# English stopword list applied while cleaning text (the common NLTK English
# list, 179 entries).
CLEANING_STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# Word-tokeniser splits that still apply once only letters and whitespace are
# left: (first part, second part), e.g. "cannot" -> "can not".
CONTRACTION_SPLITS = (
    ("can", "not"), ("gim", "me"), ("gon", "na"),
    ("got", "ta"), ("lem", "me"), ("wan", "na"),
)

# Irregular noun lemmas: (form, lemma). Forms that only look like plurals map
# to themselves.
LEMMA_EXCEPTIONS = (
    ("abdomen", "abdomen"), ("acumen", "acumen"), ("always", "always"), ("amen", "amen"), ("atlas", "atlas"),
    ("bias", "bias"), ("biases", "bias"), ("buses", "bus"), ("calves", "calf"), ("canvas", "canvas"),
    ("chaos", "chaos"), ("children", "child"), ("christmas", "christmas"), ("cookies", "cookie"),
    ("cosmos", "cosmos"), ("elves", "elf"), ("feet", "foot"), ("gas", "gas"), ("gases", "gas"), ("geese", "goose"),
    ("halves", "half"), ("hooves", "hoof"), ("kudos", "kudos"), ("knives", "knife"), ("leaves", "leaf"),
    ("lens", "lens"), ("lenses", "lens"), ("lice", "louse"), ("lies", "lie"), ("lives", "life"), ("loaves", "loaf"),
    ("mice", "mouse"), ("movies", "movie"), ("news", "news"), ("omen", "omen"), ("oxen", "ox"), ("pants", "pants"),
    ("perhaps", "perhaps"), ("pies", "pie"), ("regimen", "regimen"), ("scarves", "scarf"), ("selves", "self"),
    ("series", "series"), ("shelves", "shelf"), ("species", "species"), ("specimen", "specimen"),
    ("teeth", "tooth"), ("thieves", "thief"), ("ties", "tie"), ("towards", "towards"), ("viruses", "virus"),
    ("wives", "wife"), ("wolves", "wolf"), ("zombies", "zombie"),
)

# Strings a CSV reader treats as missing by default (exact field match).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Phrases of the synthetic sample generator.
SAMPLE_POSITIVE = (
    "I love this product!",
    "Amazing quality and fast delivery",
    "Excellent customer service",
    "Highly recommend this item",
    "Perfect for my needs",
    "Outstanding value for money",
    "Great experience overall",
    "Will definitely buy again",
)
SAMPLE_NEGATIVE = (
    "Terrible product, waste of money",
    "Poor quality and slow delivery",
    "Worst customer service ever",
    "Would not recommend",
    "Complete disappointment",
    "Overpriced and low quality",
    "Regret this purchase",
    "Never buying from here again",
)

# Split defaults: shares and seed.
TRAIN_SIZE = 0.7
TEST_SIZE = 0.2
VAL_SIZE = 0.1
RANDOM_STATE = 69

# Quality-check defaults.
VALID_LABELS = (0, 1)
MAX_MISSING_RATIO = 0.05
MIN_TEXT_LENGTH = 10
MAX_TEXT_LENGTH = 1000
MIN_SAMPLES_PER_CLASS = 10

# Metric gate defaults.
THRESHOLDS = (("accuracy", 0.8), ("f1", 0.8), ("precision", 0.75), ("recall", 0.75))

# ---------------------------------------------------------------------------
# Tables built from a rule
# ---------------------------------------------------------------------------


def _unicode_whitespace() -> tuple[str, ...]:
    # Code points Python's ``str.isspace`` (and so its ``\s``) accepts; none
    # lies above U+3000.
    return tuple(chr(c) for c in range(0x3001) if chr(c).isspace())


UNICODE_WHITESPACE = _unicode_whitespace()


def _regex_class_body(chars) -> str:
    """Characters as ``\\x{..}`` escapes, merging runs into ranges.

    RE2 (the DuckDB oracle) reads this syntax.
    """
    cps = sorted(ord(c) for c in chars)
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        out.append("\\x{%X}" % cps[i] if i == j else "\\x{%X}-\\x{%X}" % (cps[i], cps[j]))
        i = j + 1
    return "".join(out)


WS_CLASS = _regex_class_body(UNICODE_WHITESPACE)
# RE2 (DuckDB oracle) forms: the whitespace set spelled out.
NON_LETTER_PATTERN = "[^a-zA-Z" + WS_CLASS + "]"
WHITESPACE_RUN_PATTERN = "[" + WS_CLASS + "]+"
NON_WS_PATTERN = "[^" + WS_CLASS + "]"
# Java (Spark) forms of the same sets. Java's Unicode ``\s`` is the Unicode
# White_Space property; Python's ``\s`` adds U+001C..U+001F. A spelled-out
# class of escapes is several times slower in Java than the built-in one.
J_NON_LETTER_PATTERN = r"(?U)[^a-zA-Z\s\x1C-\x1F]"
J_WHITESPACE_RUN_PATTERN = r"(?U)[\s\x1C-\x1F]+"
J_NON_WS_PATTERN = r"(?U)[^\s\x1C-\x1F]"



def _accent_fold_pairs() -> tuple[str, str]:
    """(from, to) strings for ``translate``: Latin letters U+00C0..U+024F whose
    canonical decomposition starts with an ASCII letter map to that letter."""
    src, dst = [], []
    for c in range(0x00C0, 0x0250):
        ch = chr(c)
        base = unicodedata.normalize("NFKD", ch)
        if len(base) > 1 and base[0].isascii() and base[0].isalpha() \
                and all(unicodedata.combining(x) for x in base[1:]):
            src.append(ch)
            dst.append(base[0])
    return "".join(src), "".join(dst)


ACCENT_FROM, ACCENT_TO = _accent_fold_pairs()

# Declared search spaces and defaults of the model families. Settings without
# a Spark ML counterpart (solver, kernel, gamma, min_samples_split) are left out.
MODEL_GRIDS = {
    "logistic_regression": {"C": (0.1, 1.0, 10.0), "max_iter": (1000, 2000)},
    "random_forest": {"n_estimators": (50, 100, 200), "max_depth": (5, 10, None), "min_samples_leaf": (1, 2, 4)},
    "svm": {"C": (0.1, 1.0, 10.0)},
    "naive_bayes": {"alpha": (0.1, 1.0, 10.0), "fit_prior": (True, False)},
    "gradient_boosting": {"n_estimators": (50, 100, 200), "learning_rate": (0.01, 0.1, 0.2), "max_depth": (3, 5, 7)},
}
MODEL_DEFAULTS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "random_forest": {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 1},
    "svm": {"C": 1.0},
    "naive_bayes": {"alpha": 1.0, "fit_prior": True},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 5},
}
SEARCH_FOLDS = 3
SEARCH_DRAWS = 50
