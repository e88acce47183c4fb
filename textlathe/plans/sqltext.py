"""DuckDB SQL fragments that restate the text column functions.

Used only to build the oracle SQL strings in ``catalog.py`` (the correctness
gate runs those in DuckDB next to the Spark plans). They read the same fixed
values as the Spark functions, so both sides share one definition.
"""

from __future__ import annotations

from ..functions import constants as K


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def lowercase(x: str) -> str:
    return f"lower(CAST({x} AS VARCHAR))"


def strip_special(x: str) -> str:
    return f"regexp_replace({x}, {q(K.NON_LETTER_PATTERN)}, '', 'g')"


def split_contractions(x: str) -> str:
    for a, b in K.CONTRACTION_SPLITS:
        x = f"regexp_replace({x}, {q(chr(92) + 'b(' + a + ')(' + b + ')' + chr(92) + 'b')}, '\\1 \\2', 'g')"
    return x


def tokenize(x: str) -> str:
    return (f"list_filter(string_split_regex({split_contractions(x)}, {q(K.WHITESPACE_RUN_PATTERN)}), "
            f"lambda t: t <> '')")


def remove_stopwords(tokens: str, stopwords=K.CLEANING_STOPWORDS, min_length: int = 3) -> str:
    return (f"list_filter({tokens}, lambda t: length(t) >= {min_length} "
            f"AND NOT list_contains({str_list(stopwords)}, t))")


def lemma_rule(t: str = "t") -> str:
    n = f"length({t})"
    forms = str_list(f for f, _ in K.LEMMA_EXCEPTIONS)
    lemmas = str_list(x for _, x in K.LEMMA_EXCEPTIONS)
    return (f"CASE WHEN list_contains({forms}, {t}) THEN {lemmas}[list_position({forms}, {t})] "
            f"WHEN suffix({t}, 'ss') OR suffix({t}, 'us') OR suffix({t}, 'is') THEN {t} "
            f"WHEN {n} > 4 AND suffix({t}, 'men') THEN substr({t}, 1, {n} - 2) || 'an' "
            f"WHEN {n} > 4 AND suffix({t}, 'ies') THEN substr({t}, 1, {n} - 3) || 'y' "
            f"WHEN {n} > 4 AND (suffix({t}, 'sses') OR suffix({t}, 'ches') OR suffix({t}, 'shes') "
            f"OR suffix({t}, 'xes') OR suffix({t}, 'zes')) THEN substr({t}, 1, {n} - 2) "
            f"WHEN {n} > 3 AND suffix({t}, 's') THEN substr({t}, 1, {n} - 1) "
            f"ELSE {t} END")


def clean_tokens(x: str, lemmas: bool = True) -> str:
    tk = remove_stopwords(tokenize(strip_special(lowercase(x))))
    return f"list_transform({tk}, lambda t: {lemma_rule('t')})" if lemmas else tk


def clean_text(x: str, lemmas: bool = True) -> str:
    return f"array_to_string({clean_tokens(x, lemmas)}, ' ')"


def is_blank(x: str) -> str:
    return f"NOT regexp_matches({x}, {q(K.NON_WS_PATTERN)})"


def vectorizer_tokens(x: str, stopwords=K.CLEANING_STOPWORDS) -> str:
    tk = f"regexp_extract_all(lower({x}), '\\b\\w+\\b')"
    if stopwords:
        tk = f"list_filter({tk}, lambda t: NOT list_contains({str_list(stopwords)}, t))"
    return tk


def ngrams_1_2(tk: str) -> str:
    return f"list_concat({tk}, list_transform(range(1, len({tk})), lambda i: {tk}[i] || ' ' || {tk}[i + 1]))"
