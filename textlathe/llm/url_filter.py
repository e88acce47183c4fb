"""Weighted URL vocabulary: allow/block rules by host and path, then a term
score from an Aho-Corasick automaton.

The automaton holds strict and soft terms. A hit counts only between
boundaries (the characters before and after it are not ASCII letters or
digits). One strict hit, or ``min_soft`` *distinct* soft terms, rejects the
URL. The vocabulary is a parameter: a bounded list that travels to the workers
inside the function closure (checked against ``MAX_TERMS``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: default vocabulary (parameters of the operator).
STRICT_TERMS = ("porn", "xxx", "hentai", "escort", "camgirl", "warez", "keygen", "phishing")
SOFT_TERMS = ("adult", "bet", "bonus", "casino", "cheap", "click", "crack", "dating", "deal", "free",
              "gamble", "hot", "jackpot", "loan", "nude", "pills", "poker", "promo", "sex", "slots",
              "torrent", "viagra", "win")
MAX_TERMS = 1_000_000

OUTPUT = "host string, path string, rule string, n_strict int, n_soft int, verdict string"
_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first ``://`` up to ``/``, ``?``, ``#`` or
    the end, A-Z lower-cased; path from there up to ``?``, ``#`` or the end.
    Null, or no ``://``: both empty."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in (tail.find(c) for c in "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(_UPPER), tail[:stop]


def build_automaton(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton | None:
    """Automaton over the lower-cased terms; a term in both lists is strict."""
    if len(strict) + len(soft) > MAX_TERMS:
        raise ValueError(f"URL vocabulary over {MAX_TERMS} terms")
    a = ahocorasick.Automaton()
    for kind, terms in ((1, soft), (2, strict)):
        for t in terms:
            if t:
                a.add_word(t.translate(_UPPER), (kind, t.translate(_UPPER)))
    if not len(a):
        return None
    a.make_automaton()
    return a


def _inside(c: str) -> bool:
    return c.isascii() and c.isalnum()


def count_terms(automaton: ahocorasick.Automaton | None, url: str | None) -> tuple[int, int]:
    """Distinct (strict, soft) terms that stand between boundaries in the URL."""
    if not url or automaton is None:
        return 0, 0
    u = url.translate(_UPPER)
    found: set[tuple[int, str]] = set()
    for end, (kind, term) in automaton.iter(u):
        start = end - len(term) + 1
        if (start and _inside(u[start - 1])) or (end + 1 < len(u) and _inside(u[end + 1])):
            continue
        found.add((kind, term))
    strict = sum(k == 2 for k, _ in found)
    return strict, len(found) - strict


def rule_index(rules: Sequence[tuple[str, str, str]]) -> dict[str, list[tuple[str, str]]]:
    """host -> [(path, verdict)], longest path first."""
    out: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        out.setdefault(host.translate(_UPPER), []).append((path, verdict))
    return {h: sorted(v, key=lambda x: -len(x[0])) for h, v in out.items()}


def match_rule(index: dict[str, list[tuple[str, str]]], host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule (host and path together) whose host
    is ``host`` or a parent domain and whose path starts ``path``."""
    best = None
    labels = host.split(".")
    for i in range(len(labels)):
        suffix = ".".join(labels[i:])
        for p, verdict in index.get(suffix, ()):
            if path.startswith(p):
                if best is None or len(suffix) + len(p) > len(best[0]):
                    best = (suffix + p, verdict)
                break
    return best


def judge_urls(df: DataFrame, url: str = "url", *, strict: Sequence[str] = STRICT_TERMS,
               soft: Sequence[str] = SOFT_TERMS, min_soft: int = 2,
               rules: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Add ``host, path, rule, n_strict, n_soft, verdict`` to every row.

    ``rules`` are (host, path, 'allow'|'block'). A fitting rule decides;
    otherwise ``block`` if ``n_strict >= 1`` or ``n_soft >= min_soft``, else
    ``allow``. No row is dropped and no shuffle is made; a null URL, an empty
    URL, or one without ``://`` has empty host and path, fits no rule, and is
    judged by its terms (null: ``allow``). Columns of ``df`` with one of the
    output names are replaced.
    """
    index = rule_index(rules)
    strict, soft = tuple(strict), tuple(soft)
    build_automaton(strict, soft)  # check the bound before any task runs

    @F.pandas_udf(OUTPUT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = build_automaton(strict, soft)
        for urls in batches:
            rows = []
            for u in urls:
                u = u if isinstance(u, str) else None
                host, path = split_url(u)
                hit = match_rule(index, host, path) if host else None
                n_strict, n_soft = count_terms(automaton, u)
                own = "block" if n_strict or n_soft >= min_soft else "allow"
                rows.append((host, path, hit[0] if hit else None, n_strict, n_soft, hit[1] if hit else own))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "n_strict", "n_soft", "verdict"])

    names = ["host", "path", "rule", "n_strict", "n_soft", "verdict"]
    keep = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*keep, judge(F.col(url).cast("string")).alias("_judged")) \
             .select(*keep, *[F.col(f"_judged.{n}").alias(n) for n in names])
