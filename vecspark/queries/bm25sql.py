"""DuckDB text for token counts and BM25, used by the text and hybrid oracles."""

from __future__ import annotations

from collections.abc import Sequence

WORDS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"


def words(text: str) -> str:
    return WORDS.format(text=text)


def counts(source: str, key: str, fields: dict[str, tuple[str, Sequence[str]]], keep: str = "") -> str:
    """CTEs ``tok``, ``cnt`` and ``stat``; ``fields`` maps a prefix to (token SQL, terms)."""
    keep = f", {keep}" if keep else ""
    tok = ", ".join(f"{sql} AS {p}tok" for p, (sql, _) in fields.items())
    cnt, stat = [], ["count(*)::DOUBLE AS n"]
    for p, (_, terms) in fields.items():
        cnt.append(f"len({p}tok) AS {p}len")
        stat.append(f"avg({p}len)::DOUBLE AS {p}avg")
        for i, term in enumerate(terms):
            cnt.append(f"len(list_filter({p}tok, lambda x: x = '{term}')) AS {p}tf{i}")
            stat.append(f"(count(*) FILTER ({p}tf{i} > 0))::DOUBLE AS {p}df{i}")
    return f"""
    tok AS (SELECT {key}{keep}, {tok} FROM {source}),
    cnt AS (SELECT *, {', '.join(cnt)} FROM tok),
    stat AS (SELECT {', '.join(stat)} FROM cnt)
    """


def bm25(prefix: str, i: int) -> str:
    tf, df = f"{prefix}tf{i}", f"{prefix}df{i}"
    return (
        f"(CASE WHEN {tf} > 0 THEN ln(1 + (n - {df} + 0.5) / ({df} + 0.5)) * {tf} * 2.2"
        f" / ({tf} + 1.2 * (0.25 + 0.75 * {prefix}len / {prefix}avg)) ELSE 0 END)"
    )


def phrase(tokens: str, terms: Sequence[str], slop: int) -> str:
    """True where places of the terms (all different) can be chosen whose shifts differ by ``slop`` at most."""
    def choose(i: int) -> str:
        if i == len(terms):
            return "TRUE"
        places = f"list_filter(range(1, len({tokens}) + 1), lambda q{i}: {tokens}[q{i}] = '{terms[i]}')"
        near = [f"abs((p{i} - {i}) - (p{j} - {j})) <= {slop} AND p{i} <> p{j}" for j in range(i)]
        if near:
            places = f"list_filter({places}, lambda p{i}: {' AND '.join(near)})"
        return f"len(list_filter({places}, lambda p{i}: {choose(i + 1)})) > 0"

    return f"({choose(0)})"
