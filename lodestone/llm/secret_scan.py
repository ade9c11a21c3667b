"""Secret scans: fixed patterns, and a battery of randomness tests on every long run of key-like characters.

A candidate is a maximal run of 20 or more of ``A-Z a-z 0-9 + / _ = -``. Its encoding is the smallest alphabet of
``ALPHABETS`` that holds it. Three statistics are worked out: chi-squared against a uniform alphabet, the number of
runs of the sequence about its middle, and the serial correlation of neighbours. Ordinary text is the null hypothesis,
and each statistic gives a p-value: how likely text of this length and encoding looks as random as this. For chi-squared
the null comes from the characters that stand outside all candidates, for the other two from the candidates of the same
encoding and about the same length, drawn towards independent characters where there are few. Their
Cauchy combination, which holds however the three depend on each other, is the p-value of the run. What fails the runs or serial test as a random sequence (p under 1 in 1,000) is no discovery, whatever its
letters. The Benjamini-Hochberg procedure bounds the share of false discoveries among the candidates of each length
class, so that a flood of short names does not hide a long key, nor the other way round.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import running_sum
from ..functions.text import let
from .base import settle, text_of

# Fixed values of the base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAD = r"""[pPsStTaA](?i:assword|asswd|ecret|oken|pi_?key)["']?\x20*[:=]"""  # every match of ASSIGN begins so
ACCESS = r"AKIA[A-Z0-9]{12,}"  # AKIA[A-Z0-9]+ of 16 or more: a shorter run has no longer match inside
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8

RUN = r"[A-Za-z0-9+/_=-]{20,}"

# Encodings from small to large, in the order in which they are tried.
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz",
}
FALSE_DISCOVERIES = 0.01
CLASSES = 2  # of length, to a power of two
FAILED = 3.29  # standard deviations that a random sequence stays within 999 times in 1,000
PRIOR = 30  # candidates that independent characters count for in the null of runs and serial correlation
_SMALLEST = 1e-60


def _spans(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches as ``array<struct<start, end, hit>>``: what lies between them gives the places."""
    parts, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(parts, 1, F.size(hits)), hits, lambda p, h: F.struct(F.length(p).alias("gap"), h.alias("hit")))
    return F.when(F.size(hits) > 0, _placed(pairs)).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def _placed(pairs: Column) -> Column:
    """Matches (``gap`` before them, ``hit``) at their places. Running sums keep the work near the number of matches."""
    size = lambda p: p["gap"] + F.length(p["hit"])
    one = lambda end, p: F.struct((end - F.length(p["hit"])).alias("start"), end.alias("end"), p["hit"].alias("hit"))
    return let(pairs, lambda ps: F.zip_with(running_sum(F.transform(ps, size)), ps, one))


def _marks_before(places: Column, marks: Column, inclusive: bool) -> Column:
    """For each of the ascending ``places`` how many of ``marks`` lie before it, or on it if ``inclusive``."""
    asked = int(inclusive)
    event = lambda at, kind, step: F.struct(at.alias("at"), F.lit(kind).alias("kind"), F.lit(step).alias("step"))
    events = F.array_sort(F.concat(F.transform(places, lambda x: event(x, asked, 0)), F.transform(marks, lambda x: event(x, 1 - asked, 1))))

    def answers(es: Column) -> Column:
        both = F.zip_with(es, running_sum(F.transform(es, lambda e: e["step"])), lambda e, n: F.struct(e["kind"].alias("kind"), n.alias("n")))
        return F.transform(F.filter(both, lambda x: x["kind"] == asked), lambda x: x["n"])

    return let(events, answers)


def _apart(runs: Column, spans: Column) -> Column:
    """The runs that overlap none of the spans (both in order, neither overlapping its own kind): as many spans end before
    a run as begin before its end."""
    ended = _marks_before(F.transform(runs, lambda r: r["start"]), F.transform(spans, lambda s: s["end"]), True)
    begun = _marks_before(F.transform(runs, lambda r: r["end"]), F.transform(spans, lambda s: s["start"]), False)
    marked = F.zip_with(runs, F.zip_with(ended, begun, lambda e, b: e == b), lambda r, free: F.struct(r.alias("run"), free.alias("free")))
    alone = F.transform(F.filter(marked, lambda m: m["free"]), lambda m: m["run"])
    return F.when((F.size(runs) > 0) & (F.size(spans) > 0), alone).otherwise(runs)


def _found(text: Column, pattern: str, gate: Column) -> Column:
    """``_spans``, worked out only where ``gate`` says that there may be a match."""
    return F.when(gate, _spans(text, pattern)).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_assign``, ``_access``, ``_hex`` and ``_runs`` (arrays of start, end and hit). A hex match lies in a run."""
    body = text_of(text)
    value = lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= ASSIGN_VALUE
    with_runs = docs.withColumns(
        {
            "_assign": F.filter(_found(body, ASSIGN, body.rlike(ASSIGN_LEAD)), value),
            "_access": _found(body, ACCESS, body.contains("AKIA")),
            "_runs": _found(body, RUN, body.rlike(RUN)),
        }
    )
    return with_runs.withColumn("_hex", _found(body, HEX, F.exists("_runs", lambda r: r["hit"].rlike(HEX))))


def _encoding(run: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, alphabet in reversed(ALPHABETS.items()):
        escaped = alphabet.replace("-", r"\-")
        out = F.when(run.rlike(f"^[{escaped}]*$"), F.lit(name)).otherwise(out)
    return out


def _upper_tail(z: Column) -> Column:
    """The standard normal upper tail, by the error-function fit of Abramowitz and Stegun 26.2.17 and its asymptote beyond 6."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / 2.5066282746310002
    tail = F.when(x > 6, density / x * (1 - 1 / (x * x))).otherwise(density * poly)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def character_shares(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """How often each character of the largest alphabet occurs in all documents, candidates left out (at most one row a
    character reaches the driver). A row per character, combined where it is made, costs a third of a pass over the text for each of them."""
    chars = docs.select(F.explode(F.split(F.regexp_replace(text_of(text), RUN, ""), "")).alias("c")).groupBy("c").count()
    return {r["c"]: float(r["count"]) for r in chars.where(F.col("c").isin(list(ALPHABETS["base64"]))).collect()}


def background(counts: dict[str, float]) -> dict[str, tuple[int, float, float]]:
    """Per encoding: alphabet size, and mean and variance that one more character of ordinary text adds to chi-squared."""
    out = {}
    for name, alphabet in ALPHABETS.items():
        k = len(alphabet)
        total = sum(counts.get(c, 0) for c in alphabet) + k
        shares = [(counts.get(c, 0) + 1) / total for c in alphabet]
        mean = k * sum(p * p for p in shares) - 1
        spread = 4 * k * k * (sum(p**3 for p in shares) - sum(p * p for p in shares) ** 2)
        out[name] = (k, mean, max(spread, 1e-9))
    return out


def tested(scanned: DataFrame, ground: dict[str, tuple[int, float, float]]) -> DataFrame:
    """``_runs`` as ``start``, ``end``, ``enc``, ``size`` (class of length) and the statistics in standard deviations:
    ``uniform`` (how far chi-squared lies below that of text), ``runs`` and ``serial`` (from those of a random sequence)."""
    table = F.create_map(*(x for n, (k, m, v) in ground.items() for x in (F.lit(n), F.struct(F.lit(k).alias("k"), F.lit(m).alias("m"), F.lit(v).alias("v")))))
    ranks = F.create_map(*(x for n, a in ALPHABETS.items() for x in (F.lit(n), F.lit(a))))

    def numbers(run: Column) -> Column:
        chars = F.split(run["hit"], "")
        return F.struct(
            run["start"].alias("start"),
            run["end"].alias("end"),
            run["enc"].alias("enc"),
            F.length(run["hit"]).alias("n"),
            F.aggregate(
                F.array_distinct(chars),
                F.lit(0).cast("long"),
                lambda s, c: s + F.pow(F.length(run["hit"]) - F.length(F.replace(run["hit"], c, F.lit(""))), 2).cast("long"),
            ).alias("squares"),
            F.transform(chars, lambda c: F.instr(ranks[run["enc"]], c) - (table[run["enc"]]["k"] + 1) / 2.0).alias("x"),
        )

    def battery(run: Column) -> Column:
        n, k = run["n"], table[run["enc"]]["k"]
        chi = k * run["squares"] / n - n
        # Text of n characters: mean and variance of chi-squared, uniform part and what the letters' unequal shares add.
        mean = (k - 1) + n * table[run["enc"]]["m"]
        variance = 2 * (k - 1) + n * table[run["enc"]]["v"]
        # Such a sum of squares is skewed: a scaled chi-squared of the same mean and variance, by Wilson and Hilferty's cube root.
        ninth = variance / (mean * mean) / 9.0
        uniform = (1 - ninth - F.pow(chi / mean, 1 / 3)) / F.sqrt(ninth)
        pairs = F.zip_with(F.slice(run["x"], 1, n - 1), F.slice(run["x"], 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        turns = F.size(F.filter(pairs, lambda p: (p["a"] > 0) != (p["b"] > 0))) + 1
        zero = F.lit(0.0)
        product = F.aggregate(pairs, zero, lambda s, p: s + p["a"] * p["b"])
        power = F.aggregate(run["x"], zero, lambda s, a: s + a * a)
        return F.struct(
            run["start"].alias("start"),
            run["end"].alias("end"),
            run["enc"].alias("enc"),
            F.floor(F.log2(n.cast("double")) * CLASSES).cast("int").alias("size"),
            uniform.alias("uniform"),
            ((turns - (n + 1) / 2.0) / F.sqrt((n - 1) / 4.0)).alias("runs"),
            (product / F.greatest(power, F.lit(1e-9)) * F.sqrt(n)).alias("serial"),
        )

    named = F.transform("_runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["hit"].alias("hit"), _encoding(r["hit"]).alias("enc")))
    # The characters of an access or hex match are those of a run, so such a match lies in one run; an assignment may not.
    plain = F.filter("_runs", lambda r: ~r["hit"].rlike(ACCESS) & ~r["hit"].rlike(HEX))
    some = scanned.withColumn("_runs", F.when(F.size("_runs") > 0, plain).otherwise(F.col("_runs")))
    some = some.withColumn("_runs", F.when(F.size("_runs") > 0, _apart(F.col("_runs"), F.col("_assign"))).otherwise(F.col("_runs")))
    none = F.array().cast("array<struct<start:int,end:int,hit:string,enc:string>>")
    some = some.withColumn("_runs", F.when(F.size("_runs") > 0, named).otherwise(none))
    return some.withColumn("_runs", F.transform(F.transform("_runs", numbers), battery))


def nulls(scanned: DataFrame) -> Column:
    """Map from encoding and class of length to mean and standard deviation of ``runs`` and ``serial`` among the ``_runs``.

    ``PRIOR`` sequences of independent characters are counted in. A row per encoding and class reaches the driver: some
    hundreds, whatever the input.
    """
    moments = [f(c).alias(f"{n}_{c}") for c in ("runs", "serial") for n, f in (("s", F.sum), ("q", lambda c: F.sum(F.col(c) * F.col(c))))]
    found = scanned.select(F.explode("_runs").alias("r")).select("r.*").groupBy("enc", "size").agg(F.count("*").alias("n"), *moments).collect()
    table = {}
    for r in found:
        n = r["n"] + PRIOR
        of = {}
        for c in ("runs", "serial"):
            mean = r[f"s_{c}"] / n
            of[c] = {"mean": mean, "sd": max((r[f"q_{c}"] + PRIOR) / n - mean * mean, 1e-6) ** 0.5}
        table[f"{r['enc']} {r['size']}"] = of
    one = "struct<mean:double,sd:double>"
    return F.from_json(F.lit(json.dumps(table)), f"map<string,struct<runs:{one},serial:{one}>>")


def combined(run: Column, table: Column) -> Column:
    """The p-value of a run: the Cauchy combination of the three; 1 where it fails a test of randomness."""

    def close(z: Column, null: Column) -> Column:
        # How likely the null lies as near to a random sequence's value, on either side.
        return _upper_tail((null["mean"] - F.abs(z)) / null["sd"]) - _upper_tail((null["mean"] + F.abs(z)) / null["sd"])

    null = table[F.concat_ws(" ", run["enc"], run["size"].cast("string"))]
    inside = lambda p: F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(_SMALLEST))
    share = lambda p: let(inside(p) * math.pi, lambda a: F.cos(a) / F.sin(a) / 3)
    whole = share(_upper_tail(run["uniform"])) + share(close(run["runs"], null["runs"])) + share(close(run["serial"], null["serial"]))
    cauchy = F.greatest(F.atan2(F.lit(1.0), whole) / math.pi, F.lit(_SMALLEST))
    return F.when((F.abs(run["runs"]) > FAILED) | (F.abs(run["serial"]) > FAILED), F.lit(1.0)).otherwise(cauchy)


def discoveries(runs: DataFrame, share: float = FALSE_DISCOVERIES) -> dict[int, float]:
    """For each class of length the largest p-value that Benjamini and Hochberg's procedure keeps, over all ``_runs``.

    P-values are counted in bins of their logarithm first, 20 to a unit, so the driver sees 1,201 rows a class at most;
    a bin's larger end stands for all in it, which errs towards fewer discoveries. Classes without any are left out.
    """
    some = runs.select(F.explode("_runs").alias("r")).select("r.size", F.floor(-F.log10("r.p") * 20).alias("bin"))
    classes: dict[int, dict[int, int]] = {}
    for r in some.groupBy("size", "bin").count().collect():
        classes.setdefault(r["size"], {})[r["bin"]] = r["count"]
    limits = {}
    for size, bins in classes.items():
        total, kept = sum(bins.values()), 0
        for at in sorted(bins, reverse=True):
            kept += bins[at]
            edge = 10 ** (-at / 20)
            if edge <= share * kept / total:
                limits[size] = edge
    return limits


def secrets(docs: DataFrame, text: str = "text", share: float = FALSE_DISCOVERIES, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` (the text only on request), and ``found``: all spans (kind, start, end) by start, then kind.

    Kinds: ``assign``, ``access``, ``hex`` (the base patterns) and ``random`` (runs that pass the battery and overlap
    none of the others). Starts and ends count code points, ends are exclusive. A null text counts as empty and has no
    spans; so does an empty table. A column called ``found`` is replaced; names that begin with an underscore are reserved.
    Repeated rows each give a row. Texts are scanned whole and once; what is settled holds texts only if they are asked for.
    """
    ground = background(character_shares(docs, text))
    spans = tested(base_spans(docs.drop("found"), text), ground)
    scanned = settle(spans if keep_text else spans.drop(text), "secret-runs")
    table = nulls(scanned)
    rated = F.transform("_runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["size"].alias("size"), combined(r, table).alias("p")))
    limits = discoveries(scanned.select(rated.alias("_runs")), share)

    def kind(name: str, order: int, column: Column) -> Column:
        return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(name).alias("kind"), s["end"].alias("end")))

    limit = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair)) if limits else F.lit(None).cast("map<int,double>")
    chosen = F.filter(rated, lambda r: F.coalesce(r["p"] <= limit[r["size"]], F.lit(False)))
    every = F.concat(kind("assign", 0, F.col("_assign")), kind("access", 1, F.col("_access")), kind("hex", 2, F.col("_hex")), kind("random", 3, chosen))
    return scanned.withColumn("found", F.array_sort(every)).drop("_assign", "_access", "_hex", "_runs")


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``secrets``."""
    base = F.filter("found", lambda s: s["kind"] != "random")
    count = lambda name: F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", share: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with every span found by ``secrets`` replaced by ``mask``; overlapping spans give one mask. Null texts stay null."""
    others = [c for c in docs.columns if c != text]
    found = secrets(docs.select(text, F.struct(*others).alias("_others")), text, share, keep_text=True)
    body = F.col(text)
    whole = let(_merged(F.col("found")), lambda spans: _masked(body, spans, mask))
    return found.withColumn(text, F.when(F.size("found") > 0, whole).otherwise(body)).select(text, "_others.*").select(*docs.columns)


def _merged(found: Column) -> Column:
    """Spans that overlap as one, in order: ``start``, ``end`` and ``before``, where the one before ended."""
    event = lambda at, step: F.struct(at.alias("at"), F.lit(step).alias("step"))
    events = F.array_sort(F.concat(F.transform(found, lambda x: event(x["start"], 1)), F.transform(found, lambda x: event(x["end"], -1))))

    def spans(es: Column) -> Column:
        deep = F.zip_with(es, running_sum(F.transform(es, lambda e: e["step"])), lambda e, d: F.struct(e["at"].alias("at"), e["step"].alias("step"), d.alias("d")))
        at = lambda step, d: F.transform(F.filter(deep, lambda e: (e["step"] == step) & (e["d"] == d)), lambda e: e["at"])
        ends = at(-1, 0)
        pairs = F.zip_with(at(1, 1), ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))
        shifted = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
        return F.zip_with(pairs, shifted, lambda p, b: F.struct(p["start"].alias("start"), p["end"].alias("end"), b.alias("before")))

    return let(events, spans)


def _masked(body: Column, spans: Column, mask: str) -> Column:
    """The text with a mask for each span. It is cut in stretches of spans first, as finding a place in a long text takes
    time with its length."""
    length = F.greatest(F.ceil(F.sqrt(F.size(spans))).cast("int"), F.lit(1))
    stretches = F.transform(F.sequence(F.lit(1), F.greatest(F.size(spans), F.lit(1)), length), lambda i: F.slice(spans, i, length))

    def stretch(part: Column) -> Column:
        base = F.get(part, F.lit(0))["before"]
        cut = F.substring(body, base + 1, F.get(part, F.size(part) - 1)["end"] - base)
        kept = lambda own: F.transform(part, lambda p: F.concat(F.substring(own, p["before"] - base + 1, p["start"] - p["before"]), F.lit(mask)))
        return F.array_join(let(cut, kept), "")

    last = F.get(spans, F.size(spans) - 1)["end"]
    return F.concat(F.array_join(F.transform(stretches, stretch), ""), F.substring(body, last + 1, F.length(body)))
