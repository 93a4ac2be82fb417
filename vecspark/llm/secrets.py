"""Secret scans: three fixed patterns, and a randomness test battery for tokens without a name.

Everything is built-in SQL functions, and all of a document's work stays in its row.

Patterns. ``assign`` (a key word, a sign, a value of 6+ characters), ``access`` (AKIA...,
20+ characters) and ``hex`` (24+ digits). Spark has no function for the places of all
matches; they follow from the lengths of the matches and of the pieces between them.

Battery. A candidate is a run of 20+ of the base64 characters. Its encoding, and with it an
alphabet of k symbols, is inferred from the characters that occur. Against the hypothesis
"drawn evenly from the alphabet" stand the chi-squared test of the symbol counts, the runs
test of lower and upper half, and the lag-1 serial correlation; Fisher's method combines the
three into ``p_random``, and what it rejects is no secret. The other hypothesis, "ordinary
text", expects a chi-squared larger by n * lambda, with lambda from the collision rate of
ordinary text; ``p_text`` is the chance that text looks as even as this. Secrets are the
discoveries of the weighted Benjamini-Hochberg procedure on ``p_text`` over the candidates
of all documents, where longer tokens, for which the test has more power, weigh more.

The threshold comes from a histogram of the p-values, whose size is fixed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.llm.common import LOWER, UPPER
from vecspark.session import materialise

# The patterns and least lengths of the base kinds, in the order of the kinds.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
TOKEN = "[A-Za-z0-9+/_-]{20,}"
#: Stands for a character of a base span while tokens are looked for.
COVER = "\x01"
#: States that are added to one array one by one, and characters of a text that are cut out of one block.
STEP, CUT = 128, 1024
KINDS = ("assign", "access", "hex", "random")

DIGITS = "0123456789"
#: name, pattern that a token must match whole, alphabet; the first that matches is inferred.
ENCODINGS = (
    ("decimal", "[0-9]+", DIGITS),
    ("hex", "[0-9a-f]+", DIGITS + "abcdef"),
    ("HEX", "[0-9A-F]+", DIGITS + "ABCDEF"),
    ("letters", "[a-z]+", LOWER),
    ("LETTERS", "[A-Z]+", UPPER),
    ("base32", "[A-Z2-7]+", UPPER + "234567"),
    ("base36", "[a-z0-9]+", LOWER + DIGITS),
    ("BASE36", "[A-Z0-9]+", UPPER + DIGITS),
    ("mixed", "[A-Za-z]+", UPPER + LOWER),
    ("base62", "[A-Za-z0-9]+", UPPER + LOWER + DIGITS),
    ("base64", "[A-Za-z0-9+/]+", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "[A-Za-z0-9_-]+", UPPER + LOWER + DIGITS + "-_"),
    ("base66", ".+", UPPER + LOWER + DIGITS + "+/-_"),
)
#: Chance that two characters of ordinary text agree, for alphabets with letters and without.
COLLISION, COLLISION_DIGITS = 0.066, 0.125
FDR = 0.05
LEAST_RANDOM = 0.001
#: Histogram of -log10(p): 50 bins for each power of ten, down to 1e-40.
BINS_PER_TEN, MOST_TENS = 50, 40


def normal_cdf(z: Column) -> Column:
    """The normal distribution function (Zelen and Severo's polynomial, error below 1e-7)."""
    x = F.least(F.abs(z), F.lit(13.0))
    t = 1 / (1 + 0.2316419 * x)
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    return F.when(z > 0, 1 - tail).otherwise(tail)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, zero: Column, step) -> Column:
    """All states of a fold over ``items``, in time that follows their number.

    Adding to an array copies it, so states are gathered in blocks of ``STEP`` and the blocks
    in an outer array.
    """
    none = F.slice(F.array(zero), 1, 0)

    def over(every: Column) -> Column:
        count = F.ceil(F.size(every) / STEP).cast("int")
        numbers = F.filter(F.sequence(F.lit(0), count), lambda b: b < count)

        def block(state: Column, b: Column) -> Column:
            own = F.aggregate(
                F.slice(every, b * STEP + 1, F.lit(STEP)), F.struct(state["at"].alias("at"), none.alias("out")),
                lambda acc, x: _let(step(acc["at"], x), lambda n: F.struct(n.alias("at"), F.concat(acc["out"], F.array(n)).alias("out"))),
            )
            return _let(own, lambda r: F.struct(r["at"].alias("at"), F.concat(state["out"], F.array(r["out"])).alias("out")))

        start = F.struct(zero.alias("at"), F.slice(F.array(none), 1, 0).alias("out"))
        return F.flatten(F.aggregate(numbers, start, block, lambda acc: acc["out"]))

    return _let(items, over)


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<match, gap>>: each match and the length of what lies between it and the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("match"), F.transform(pieces, F.length).alias("gap"))
    return F.filter(pairs, lambda p: p["match"].isNotNull())


def _placed(text: Column, pattern: str) -> Column:
    """array<struct<match, start, end>> of all matches, in code points."""
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))

    def step(at: Column, pair: Column) -> Column:
        start = at["end"] + pair["gap"]
        return F.struct(start.alias("start"), (start + F.length(pair["match"])).alias("end"))

    return _let(_matches(text, pattern), lambda pairs: F.zip_with(
        pairs, running(pairs, zero, step), lambda p, at: F.struct(p["match"].alias("match"), at["start"].alias("start"), at["end"].alias("end"))
    ))


def _match_spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """array<struct<start, end, kind>> of the matches whose text satisfies ``keep``."""
    none = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    spans = F.transform(
        F.filter(_placed(text, pattern), lambda m: keep(m["match"])),
        lambda m: F.struct(m["start"], m["end"], F.lit(kind).alias("kind")),
    )
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _covered(text: Column, pattern: str, keep) -> Column:
    """``text`` with ``COVER`` for each character of the matches that satisfy ``keep``."""

    def join(t: Column) -> Column:
        pieces = F.zip_with(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1),
            lambda m, gap: F.concat(gap, F.when(m.isNull(), "").when(keep(m), F.repeat(F.lit(COVER), F.length(m))).otherwise(m)),
        )
        return F.array_join(pieces, "")

    return F.when(text.rlike(pattern), _let(text, join)).otherwise(text)


def _all(match: Column) -> Column:
    return F.lit(True)


def _long_value(match: Column) -> Column:
    return F.length(F.regexp_replace(match, VALUE, "")) >= 6


#: Pattern of each base kind, and which matches count.
BASE = ((ASSIGN, _long_value), (ACCESS, _all), (HEX, _all))


def base_spans(text: Column) -> Column:
    """The spans of the three base kinds, by start and then kind."""
    return _in_order(F.concat(*[_match_spans(text, pattern, kind, keep) for kind, (pattern, keep) in enumerate(BASE)]))


def free_tokens(text: Column, has_base: Column) -> Column:
    """array<struct<token, start, end>> of the tokens that overlap no base span.

    Base spans are covered first. A token that overlaps one touches the cover and is one match with
    it: the part of a span that is not covered, because an earlier kind took the rest, is token characters only.
    """
    plain = F.translate(text, COVER, "\x02")  # another character that is in no pattern
    masked = plain
    for pattern, keep in BASE:
        masked = _covered(masked, pattern, keep)
    open_to = TOKEN.replace("[", "[" + COVER, 1)
    # Positions follow from the lengths of all matches, those with a cover included.
    found = _placed(F.when(has_base, masked).otherwise(plain), open_to)
    own = F.filter(found, lambda m: ~F.contains(m["match"], F.lit(COVER)))
    return F.transform(own, lambda m: F.struct(m["start"], m["end"], m["match"].alias("token")))


def _in_order(spans: Column) -> Column:
    return F.array_sort(
        spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    )


def _pick(encoding: Column, values: dict[str, object]) -> Column:
    out = None
    for name, value in values.items():
        hit = encoding == name
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def inferred_encoding(token: Column) -> Column:
    out = None
    for name, pattern, _ in ENCODINGS:
        hit = token.rlike(f"^{pattern}$")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (column token, non-empty) with encoding, p_chi, p_runs, p_serial, p_random, p_text."""
    alphabet = _pick(F.col("encoding"), {n: a for n, _, a in ENCODINGS})
    size = F.length("alphabet")
    lower_half = {n: "0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2) for n, _, a in ENCODINGS}
    halves = None
    for name, _, letters in ENCODINGS:
        turned = F.translate("token", letters, lower_half[name])
        halves = F.when(F.col("encoding") == name, turned) if halves is None else halves.when(
            F.col("encoding") == name, turned
        )
    df = tokens.withColumn("encoding", inferred_encoding(F.col("token"))).withColumn("alphabet", alphabet)
    df = df.withColumn("n", F.length("token")).withColumn("k", size).withColumn("_half", halves)
    symbols = F.split("token", "")
    # Symbol counts by the length that is lost when the symbol is taken out: at most 66 passes.
    squares = F.aggregate(
        F.array_distinct(symbols), F.lit(0.0),
        lambda acc, c: acc + F.pow((F.col("n") - F.length(F.replace(F.col("token"), c, F.lit("")))).cast("double"), F.lit(2.0)),
    )
    df = df.withColumn("chi2", F.col("k") / F.col("n") * squares - F.col("n")).withColumn("_f", (F.col("k") - 1).cast("double"))
    cube = F.pow(F.greatest(F.col("chi2"), F.lit(0.0)) / F.col("_f"), F.lit(1 / 3))
    spread = 2 / (9 * F.col("_f"))
    p_chi = 1 - normal_cdf((cube - (1 - spread)) / F.sqrt(spread))

    ones = F.length(F.replace(F.col("_half"), F.lit("0"), F.lit(""))).cast("double")
    zeros = F.col("n") - ones
    turns = sum(
        (F.col("n") - F.length(F.replace(F.col("_half"), F.lit(x), F.lit("")))) / 2 for x in ("01", "10")
    )
    mean = 2 * ones * zeros / F.col("n") + 1
    variance = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    p_runs = F.when(
        (ones > 0) & (zeros > 0) & (variance > 0),
        2 * (1 - normal_cdf(F.abs(turns + 1 - mean) / F.sqrt(F.greatest(variance, F.lit(1e-9))))),
    ).otherwise(F.lit(1e-12))

    df = df.withColumn("_v", F.transform(symbols, lambda c: F.instr(F.col("alphabet"), c).cast("double")))
    df = df.withColumn("_m", F.aggregate("_v", F.lit(0.0), lambda a, v: a + v) / F.size("_v"))
    df = df.withColumn("_v", F.transform("_v", lambda v: v - F.col("_m")))
    energy = F.aggregate("_v", F.lit(0.0), lambda a, v: a + v * v)
    lagged = F.aggregate(
        F.zip_with(F.slice("_v", F.lit(2), F.size("_v")), "_v", lambda x, y: F.coalesce(x, F.lit(0.0)) * y),
        F.lit(0.0), lambda a, v: a + v,
    )
    z = (F.when(energy > 0, lagged / F.greatest(energy, F.lit(1e-9))).otherwise(1.0) + 1 / F.col("n")) * F.sqrt("n")
    p_serial = 2 * (1 - normal_cdf(F.abs(z)))

    df = df.withColumns({"p_chi": p_chi, "p_runs": p_runs, "p_serial": p_serial})
    half = -sum(F.log(F.greatest(F.col(p), F.lit(1e-12))) for p in ("p_chi", "p_runs", "p_serial"))
    rate = F.when(F.col("k") > 16, COLLISION).otherwise(COLLISION_DIGITS)
    extra = F.col("n") * (F.col("k") * rate - 1)
    text_z = (F.col("chi2") - F.col("_f") - extra) / F.sqrt(2 * F.col("_f") + 4 * extra)
    df = df.withColumns({
        "p_random": F.exp(-half) * (1 + half + half * half / 2), "p_text": normal_cdf(text_z),
    })
    return df.drop("alphabet", "_half", "_f", "_v", "_m", "chi2", "k", "n")


def discoveries(candidates: DataFrame, q: float = FDR) -> tuple[float, float]:
    """(threshold, mean power) of the weighted procedure over ``candidates`` (n, p_text, times).

    A candidate is discovered if p_text * mean power / power(n) <= threshold.
    """
    power = _power(F.col("n"))
    total, mean = candidates.agg(F.sum("times"), F.sum(power * F.col("times")) / F.sum("times")).first()
    if not total:
        return 0.0, 1.0
    adjusted = F.greatest(F.col("p_text") * mean / power, F.lit(10.0**-MOST_TENS))
    bins = candidates.groupBy(F.floor(-F.log10(adjusted) * BINS_PER_TEN).alias("bin")).agg(F.sum("times").alias("times"))
    seen, best = 0, 0.0
    for row in sorted(bins.collect(), key=lambda r: -r["bin"]):  # a fixed number of bins
        seen += row["times"]
        most = 10.0 ** (-row["bin"] / BINS_PER_TEN)
        if most * total / seen <= q:
            best = max(best, most)
    return best, mean


def _power(n: Column) -> Column:
    """Weight of a length: what the test can tell apart saturates at some hundred characters."""
    return 1 - F.exp(-n / 32.0)


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", q: float = FDR, carry_rows: bool = False,
) -> DataFrame:
    """One row per document: key, base and spans, both array<struct<start, end, kind>> by start
    and then kind (code points, end exclusive; kind is a place in ``KINDS``).

    ``spans`` holds the base spans and the random tokens that overlap none of them. Null
    texts are empty; repeated rows are scanned each. ``carry_rows`` adds the whole input
    row as the struct ``row``. The texts are scanned once; what later steps need is written
    to the checkpoint folder, numbered, so that neither key nor text must be unique.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    carried = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry_rows else []
    rows = docs.select(F.col(f"`{key}`").alias("_id"), body.alias("_t"), *carried)
    any_base = F.col("_t").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")
    nothing = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    rows = rows.withColumn("base", F.when(any_base, base_spans(F.col("_t"))).otherwise(nothing))
    none = F.array().cast("array<struct<start:int,end:int,token:string>>")
    found = F.when(F.col("_t").rlike(TOKEN), free_tokens(F.col("_t"), any_base)).otherwise(none)
    rows = rows.select(F.monotonically_increasing_id().alias("_rid"), "_id", "base", found.alias("_c"), *["row"] * carry_rows)
    rows = materialise(rows, "secrets")

    found = rows.where(F.size("_c") > 0).select("_rid", F.explode("_c").alias("c")).select("_rid", "c.*")
    tested = found.groupBy("token").agg(F.count("*").alias("times"))
    tested = materialise(battery(tested), "secret-tokens")
    threshold, mean = discoveries(tested.withColumn("n", F.length("token")), q)
    secret = tested.where(
        (F.col("p_text") * mean / _power(F.length("token")) <= threshold) & (F.col("p_random") >= LEAST_RANDOM)
    )
    extra = found.join(secret.select("token"), "token").groupBy("_rid").agg(
        F.collect_list(F.struct("start", "end", F.lit(3).alias("kind"))).alias("_extra")
    )
    spans = _in_order(F.concat("base", F.coalesce("_extra", nothing)))
    return rows.join(extra, "_rid", "left").select(
        F.col("_id").alias(key), "base", spans.alias("spans"), *["row"] * carry_rows
    )


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def without(body: Column, spans: Column, mark: str) -> Column:
    """``body`` with ``mark`` in place of each run of overlapping ``spans`` (by start)."""
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))

    def step(at: Column, s: Column) -> Column:
        inside = s["start"] < at["end"]
        return F.struct(
            F.when(inside, at["start"]).otherwise(s["start"]).alias("start"),
            F.when(inside, F.greatest(at["end"], s["end"])).otherwise(s["end"]).alias("end"),
        )

    last = lambda every: F.filter(
        every, lambda r, i: F.coalesce(F.get(every, i + 1)["start"] != r["start"], F.lit(True))
    )
    runs = _let(running(spans, zero, step), last)
    # A substring is found by counting from the start, so it is taken from a block of the text.
    blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        first, final = F.floor(a / CUT).cast("int"), F.floor(b / CUT).cast("int")
        head = F.substring(F.get(blocks, first), a % CUT + 1, F.least(b - a, F.lit(CUT)))
        middle = F.array_join(F.slice(blocks, first + 2, F.greatest(final - first - 1, F.lit(0))), "")
        tail = F.substring(F.coalesce(F.get(blocks, final), F.lit("")), F.lit(1), b % CUT)
        return F.when(b <= a, "").when(first == final, head).otherwise(F.concat(head, middle, tail))

    def pieces(r: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(r, lambda x: x["end"]))
        ends = F.concat(F.transform(r, lambda x: x["start"]), F.array(F.length(body)))
        return F.arrays_zip(starts.alias("a"), ends.alias("b"))

    cut = _let(blocks, lambda own: F.transform(_let(runs, pieces), lambda p: piece(own, p["a"], p["b"])))
    return F.array_join(cut, mark)


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with ``mark`` in place of each secret (overlapping spans become one); all other
    columns, and texts without secrets (null ones too), as they were."""
    found = scan(docs, key, text, carry_rows=True, **options)
    body = F.col("row")[text]
    clean = F.when(F.size("spans") > 0, without(body, F.col("spans"), mark)).otherwise(body)
    out = found.withColumn("_clean", clean)
    return out.select(*[
        F.col("_clean").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns
    ])
