"""Text column functions: ``Column -> Column``, all JVM-side.

No Python UDF is used; every function is a composition of built-in Spark SQL
expressions (regexp, split, higher-order array functions), so it runs inside
whole-stage code generation and works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _str_array(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


# --- B4 ---------------------------------------------------------------------
def lowercase(c) -> Column:
    """Cast to string and lowercase."""
    return F.lower(_col(c).cast("string"))


# --- B5 helpers -------------------------------------------------------------
def strip_unicode(c) -> Column:
    """Remove leading/trailing Unicode whitespace (``trim`` only drops 0x20)."""
    ws = r"[\s\x1C-\x1F]+"
    return F.regexp_replace(_col(c), "(?U)^" + ws + "|" + ws + "$", "")


def is_blank(c) -> Column:
    """True when the string has no non-whitespace character. A short prefix
    decides for ordinary text, so that the whole of it is not decoded."""
    x = _col(c).cast("string")
    return ~F.substring(x, 1, 64).rlike(K.J_NON_WS_PATTERN) & ~x.rlike(K.J_NON_WS_PATTERN)


# --- B8 ---------------------------------------------------------------------
def strip_special(c) -> Column:
    """Drop every character that is not an ASCII letter or whitespace."""
    return F.regexp_replace(_col(c), K.J_NON_LETTER_PATTERN, "")


def _contraction_pattern() -> str:
    alts = "|".join(f"{a}(?={b}\\b)" for a, b in K.CONTRACTION_SPLITS)
    return f"\\b({alts})"


CONTRACTION_PATTERN = _contraction_pattern()


# --- B9 ---------------------------------------------------------------------
def tokenize(c) -> Column:
    """Whitespace tokens after the six contraction splits.

    Once only letters and whitespace are left, word tokenisation reduces to
    this. Empty strings from leading whitespace are removed.
    """
    return F.filter(_pieces(c), lambda t: t != F.lit(""))


def _pieces(c) -> Column:
    spaced = F.regexp_replace(_col(c), CONTRACTION_PATTERN, "$1 ")
    return F.split(spaced, K.J_WHITESPACE_RUN_PATTERN)


# --- B10 / B11 --------------------------------------------------------------
def remove_stopwords(tokens, stopwords: Iterable[str] = K.CLEANING_STOPWORDS,
                     min_length: int = 3) -> Column:
    """Keep tokens not in ``stopwords`` and at least ``min_length`` long.

    ``isin`` with many literals is planned as a hash-set lookup (InSet).
    """
    sw = tuple(stopwords)
    def keep(t):
        cond = F.length(t) >= F.lit(min_length)
        if sw:
            cond = cond & ~t.isin(*sw)
        return cond
    return F.filter(_col(tokens), keep)


# --- B12 --------------------------------------------------------------------
def lemma_rule(t: Column) -> Column:
    """Noun lemma of one token without a lexicon: irregular forms first, then
    suffix rules.

    Endings ``ss``/``us``/``is`` are kept; ``men`` -> ``man``; ``ies`` ->
    ``y``; ``sses``/``ches``/``shes``/``xes``/``zes`` lose ``es``; a final
    ``s`` is dropped. Stems keep at least two letters. ``ses`` and ``ves`` have
    no safe rule (houses/buses, gives/knives), so they lose ``s`` unless
    listed. With a lexicon, use :func:`clean_text`'s ``lemmas=False`` and
    :func:`textlathe.operators.cleaning.lemmatize_with_lexicon`.
    """
    n = F.length(t)
    def cut(k):
        return F.substring(t, F.lit(1), n - F.lit(k))
    es_end = (t.endswith("sses") | t.endswith("ches") | t.endswith("shes")
              | t.endswith("xes") | t.endswith("zes"))
    irregular = dict(K.LEMMA_EXCEPTIONS)
    other = [t.endswith(x) for x in sorted({form[-3:] for form in irregular if not form.endswith("s")} | {"men"})]
    out = F.when(~reduce(lambda a, b: a | b, other, t.endswith("s")), t)  # most tokens end here
    lemmas = F.create_map(*[F.lit(x) for pair in irregular.items() for x in pair])
    out = out.when(t.isin(*irregular), F.element_at(lemmas, t))
    return (out.when(t.endswith("ss") | t.endswith("us") | t.endswith("is"), t)
             .when((n > 4) & t.endswith("men"), F.concat(cut(2), F.lit("an")))
             .when((n > 4) & t.endswith("ies"), F.concat(cut(3), F.lit("y")))
             .when((n > 4) & es_end, cut(2))
             .when((n > 3) & t.endswith("s"), cut(1))
             .otherwise(t))


def lemmatize(tokens) -> Column:
    return F.transform(_col(tokens), lemma_rule)


# --- B7 / B13 ---------------------------------------------------------------
def clean_tokens(c, stopwords: Iterable[str] = K.CLEANING_STOPWORDS,
                 lemmas: bool = True) -> Column:
    # the length rule drops empty pieces too
    tk = remove_stopwords(_pieces(strip_special(lowercase(c))), stopwords)
    return lemmatize(tk) if lemmas else tk


def clean_text(c, stopwords: Iterable[str] = K.CLEANING_STOPWORDS,
               lemmas: bool = True) -> Column:
    """lowercase -> strip specials/digits -> tokenise -> stopwords/length ->
    lemmatise -> join with single spaces."""
    return F.array_join(clean_tokens(c, stopwords, lemmas), " ")


# --- F2 ---------------------------------------------------------------------
def strip_accents(c) -> Column:
    """Fold accented Latin letters to their base letter via ``translate``."""
    return F.translate(_col(c), K.ACCENT_FROM, K.ACCENT_TO)


WORD_PATTERN = "(?U)\\b\\w+\\b"
ASCII_WORD_PATTERN = "\\w+"


def vectorizer_tokens(c, stopwords: Iterable[str] | None = K.CLEANING_STOPWORDS,
                      lowercase_: bool = True, accents: bool = True) -> Column:
    """Tokens as the TF-IDF vectoriser sees them: lowercase, accent fold,
    ``\\b\\w+\\b`` matches, stopword filter (no length rule). ASCII text has
    no accents, and its words are those of the plain pattern."""
    raw = _col(c).cast("string")
    x = F.lower(raw) if lowercase_ else raw
    folded = strip_accents(x) if accents else x
    tk = (F.when(F.octet_length(raw) == F.length(raw), F.regexp_extract_all(x, F.lit(ASCII_WORD_PATTERN), 0))
           .otherwise(F.regexp_extract_all(folded, F.lit(WORD_PATTERN), 0)))
    sw = tuple(stopwords or ())
    if sw:
        tk = F.filter(tk, lambda t: ~t.isin(*sw))
    return tk


# --- F3 ---------------------------------------------------------------------
def ngrams_1_2(tokens) -> Column:
    """Unigrams followed by bigrams, in text order.

    ``zip_with`` over two slices; the token array must be a materialised
    column (not an inline expression) so it is evaluated once per row.
    """
    tk = _col(tokens)
    m = F.greatest(F.size(tk) - 1, F.lit(0))
    bi = F.zip_with(F.slice(tk, 1, m), F.slice(tk, 2, m), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tk, bi)


def bigrams(tokens) -> Column:
    tk = _col(tokens)
    m = F.greatest(F.size(tk) - 1, F.lit(0))
    return F.zip_with(F.slice(tk, 1, m), F.slice(tk, 2, m), lambda a, b: F.concat(a, F.lit(" "), b))


# --- F4 (row-local part) ----------------------------------------------------
def run_starts(sorted_terms) -> Column:
    """1-based positions where a new distinct value starts in a *sorted* array
    (a materialised column). Linear in the array size."""
    s = _col(sorted_terms)
    n = F.size(s)
    return F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                    lambda i: ~F.get(s, i - 1).eqNullSafe(F.get(s, i - 2)))  # past either end: null


def term_counts(sorted_terms, starts) -> Column:
    """``array<struct<term, tf>>``: one entry per distinct term with its count,
    from a sorted term array and its :func:`run_starts`.

    Counting inside each row means (doc, term) frequencies need no shuffle.
    """
    s, st = _col(sorted_terms), _col(starts)
    ends = F.slice(F.concat(F.slice(st, 2, F.greatest(F.size(st) - 1, F.lit(0))), F.array(F.size(s) + 1)),
                   1, F.size(st))
    return F.zip_with(st, ends, lambda a, b: F.struct(F.element_at(s, a).alias("term"),
                                                       (b - a).cast("long").alias("tf")))


def text_length(c) -> Column:
    """Length in code points."""
    return F.length(_col(c)).cast("int")
