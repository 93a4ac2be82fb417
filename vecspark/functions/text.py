"""Tokenisers, match predicates and BM25 terms as Spark Columns.

Parsers: ``space`` (default; runs of letters and digits), ``beng`` (the same
without English stop words), ``ngram`` (pairs of characters inside each run),
``ngram2`` (pairs and triples), ``ik`` and ``jieba`` (words, with pairs of
characters for Chinese, Japanese and Korean text). Other names behave as ``space``.
All lower-case their input.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import regex
from pyspark.sql import Column, functions as F

# English stop words of the ``beng`` parser.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()

# BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75

# Possessive: a run of letters and digits never gives characters back.
WORD = r"[\p{L}\p{N}]++"
# A token and its repeats, in tokens joined by spaces. Possessive: no step is kept for a repeat.
RUN = r"([^ ]++)(?: \1(?![^ ]))*+"
_NOT_IN_WORD = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_CJK = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}"
_CJK_OR_WORD = rf"[{_CJK}]+|[\p{{L}}\p{{N}}&&[^{_CJK}]]+"
_PY_CJK = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}"
_PY_CJK_OR_WORD = rf"(?V1)[{_PY_CJK}]+|[[\p{{L}}\p{{N}}]--[{_PY_CJK}]]+"

_NGRAM_SIZES = {"ngram": (2,), "ngram2": (2, 3)}
_SEGMENTED = ("ik", "jieba")


def parser_name(parser: str | None) -> str:
    name = (parser or "space").lower()
    return name if name in ("space", "beng", *_NGRAM_SIZES, *_SEGMENTED) else "space"


def _text(column: Column | str) -> Column:
    return F.lower(F.col(column) if isinstance(column, str) else column)


def _runs(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _grams(run: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of a run, in order; a shorter run stays whole."""
    parts = []
    for n in sizes:
        starts = F.sequence(F.lit(1), F.length(run) - (n - 1))
        parts.append(
            F.when(
                F.length(run) >= n, F.transform(starts, lambda i: F.substring(run, i, F.lit(n)))
            ).otherwise(F.array().cast("array<string>"))
        )
    whole = F.when(F.length(run) < min(sizes), F.array(run)).otherwise(
        F.array().cast("array<string>")
    )
    return F.concat(*parts, whole)


def tokens(column: Column | str, parser: str = "space") -> Column:
    """All tokens of a text in order, with repeats; null for a null text."""
    parser = parser_name(parser)
    text = _text(column)
    if parser in _NGRAM_SIZES:
        sizes = _NGRAM_SIZES[parser]
        return F.flatten(F.transform(_runs(text), lambda run: _grams(run, sizes)))
    if parser in _SEGMENTED:
        runs = _runs(text, _CJK_OR_WORD)
        return F.flatten(
            F.transform(
                runs,
                lambda run: F.when(run.rlike(f"^[{_CJK}]"), _grams(run, (2,))).otherwise(
                    F.array(run)
                ),
            )
        )
    words = _runs(text)
    if parser == "beng":
        return F.filter(words, lambda w: ~w.isin(STOP_WORDS))
    return words


def _python_grams(run: str, sizes: tuple[int, ...]) -> list[str]:
    if len(run) < min(sizes):
        return [run]
    return [run[i : i + n] for n in sizes for i in range(len(run) - n + 1)]


def query_words(query: str, parser: str = "space") -> list[list[str]]:
    """A query text as words, each a list of the tokens that stand for it."""
    parser = parser_name(parser)
    text = query.lower()
    if parser in _SEGMENTED:
        runs = regex.findall(_PY_CJK_OR_WORD, text)
        cjk = regex.compile(rf"[{_PY_CJK}]")
        return [_python_grams(r, (2,)) if cjk.match(r) else [r] for r in runs]
    words = regex.findall(WORD, text)
    if parser in _NGRAM_SIZES:
        return [_python_grams(w, _NGRAM_SIZES[parser]) for w in words]
    if parser == "beng":
        words = [w for w in words if w not in STOP_WORDS]
    return [[w] for w in words]


def query_tokens(query: str, parser: str = "space") -> list[str]:
    """Distinct tokens of a query, in order of first use."""
    return list(dict.fromkeys(t for word in query_words(query, parser) for t in word))


def match_any(query: str, *columns: Column | str, parser: str = "space") -> Column:
    """True where at least one query word occurs in any of the columns.

    A word of several tokens (n-grams) occurs where all of them do. Word tokens
    are found by one pass of a bounded pattern and n-grams by substring search, so
    the text is never split into a token array.
    """
    if not columns:
        raise ValueError("a match needs at least one column")
    parser = parser_name(parser)
    words = query_words(query, parser)
    if not words:
        return F.lit(False)
    per_column = [F.coalesce(_column_match(_text(c), words, parser), F.lit(False)) for c in columns]
    result = per_column[0]
    for matched in per_column[1:]:
        result = result | matched
    return result


def _column_match(text: Column, words: list[list[str]], parser: str) -> Column:
    if parser in _SEGMENTED and any(len(w) > 1 or _is_cjk(w[0]) for w in words):
        found = tokens(text, parser)
        tests = [F.size(F.array_except(F.lit(list(w)), found)) == 0 for w in map(set, words)]
    elif parser in _NGRAM_SIZES:
        tests = []
        shortest = min(_NGRAM_SIZES[parser])
        for word in words:
            if len(word[0]) < shortest:
                tests.append(text.rlike(_whole_word([word[0]])))
                continue
            # A gram lies inside one run exactly where it is a substring of the text.
            grams = [F.contains(text, F.lit(g)) for g in dict.fromkeys(word)]
            test = grams[0]
            for gram in grams[1:]:
                test = test & gram
            tests.append(test)
    elif parser in _SEGMENTED:
        found = tokens(text, parser)
        tests = [F.arrays_overlap(found, F.lit([w[0] for w in words]))]
    else:
        tests = [text.rlike(_whole_word([w[0] for w in words]))]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def _is_cjk(token: str) -> bool:
    return bool(regex.match(rf"[{_PY_CJK}]", token))


def _whole_word(words: list[str]) -> str:
    before, after = _NOT_IN_WORD
    return before + "(?:" + "|".join(re.escape(w) for w in dict.fromkeys(words)) + ")" + after


def term_frequency(token_array: Column, term: str) -> Column:
    return F.size(token_array) - F.size(F.array_remove(token_array, F.lit(term)))


def idf(n_docs: Column, doc_freq: Column) -> Column:
    n, df = n_docs.cast("double"), doc_freq.cast("double")
    return F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))


def bm25_term(tf: Column, length: Column, avg_length: Column, idf_value: Column) -> Column:
    tf, length = tf.cast("double"), length.cast("double")
    norm = F.lit(BM25_K1) * (F.lit(1.0 - BM25_B) + F.lit(BM25_B) * length / avg_length)
    return F.when(tf > 0, idf_value * tf * F.lit(BM25_K1 + 1.0) / (tf + norm)).otherwise(0.0)


@dataclass(frozen=True)
class Clause:
    """One part of a query text: a word or a phrase, with its weight."""

    terms: tuple[str, ...]
    weight: float = 1.0
    slop: int | None = None  # None: a single word; otherwise a phrase

    @property
    def is_phrase(self) -> bool:
        return self.slop is not None


_CLAUSE = regex.compile(
    r"""\(\s*(?:"(?P<p1>[^"]*)"(?:~(?P<s1>\d+))?|(?P<w1>[^()"]+?))\s*\)\s*(?:\^(?P<b1>[\d.]+))?"""
    r"""|"(?P<p2>[^"]*)"(?:~(?P<s2>\d+))?(?:\^(?P<b2>[\d.]+))?"""
    r"""|(?P<w2>[^\s()"^]+)(?:\^(?P<b2w>[\d.]+))?"""
)


def query_clauses(query: str, parser: str = "space") -> list[Clause]:
    """Split ``(word)^w``, ``("a phrase"~slop)^w`` and bare words into clauses."""
    text = query.strip()
    while _wraps_all(text) and "(" in text[1:]:
        text = text[1:-1].strip()
    clauses = []
    for m in _CLAUSE.finditer(text):
        phrase = m["p1"] if m["p1"] is not None else m["p2"]
        weight = float(m["b1"] or m["b2"] or m["b2w"] or 1.0)
        if phrase is not None:
            terms = tuple(t for word in query_words(phrase, parser) for t in word)
            if terms:
                clauses.append(Clause(terms, weight, int(m["s1"] or m["s2"] or 0)))
            continue
        for word in query_words(m["w1"] or m["w2"] or "", parser):
            if len(word) == 1:
                clauses.append(Clause((word[0],), weight))
            else:
                clauses.append(Clause(tuple(word), weight, 0))
    return clauses


def _wraps_all(text: str) -> bool:
    """True when the text starts with a bracket that closes at the very end."""
    if not text.startswith("("):
        return False
    depth = 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if depth == 0:
            return i == len(text) - 1
    return False


def phrase_match(token_array: Column, clause: Clause) -> Column:
    """True where the terms occur in order, with moves of ``slop`` tokens in all.

    Each term takes a token of its own. A token's shift is its place less the term's place
    in the phrase; the phrase occurs where all shifts lie within ``slop`` of the smallest.
    """
    terms, slop = list(clause.terms), clause.slop or 0
    places = {term: [i for i, t in enumerate(terms) if t == term] for term in terms}

    def holds(all_tokens: Column, shift: Column) -> Column:
        """All terms have tokens when the smallest shift is ``shift``."""
        result = F.lit(True)
        for term, at in places.items():
            # Equally long windows get distinct tokens where no run of windows has too few.
            for i, first in enumerate(at):
                for j, last in enumerate(at[i:]):
                    start = F.greatest(shift + F.lit(first + 1), F.lit(1))
                    length = F.greatest(shift + F.lit(last + slop + 2) - start, F.lit(0))
                    window = F.slice(all_tokens, start, length)
                    if j:
                        result = result & (term_frequency(window, term) > j)
                    else:
                        result = result & F.array_contains(window, term)
        return result

    def occurs(all_tokens: Column) -> Column:
        indexed = F.transform(all_tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
        if not slop:
            starts = F.filter(indexed, lambda e: e["t"] == terms[0])
            return F.exists(starts, lambda e: holds(all_tokens, e["i"]))
        starts = F.filter(indexed, lambda e: e["t"].isin(list(places)))
        offsets = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("o")) for i, t in enumerate(terms)])
        return F.exists(
            starts,
            lambda e: F.exists(offsets, lambda x: (x["t"] == e["t"]) & holds(all_tokens, e["i"] - x["o"])),
        )

    # Inside a transform, so that the tokens are made once for each row.
    return F.get(F.transform(F.array(token_array), occurs), F.lit(0))
