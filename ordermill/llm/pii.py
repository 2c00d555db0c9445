"""Personal data by candidate spans, boosted trees and calibrated thresholds.

All steps are DataFrame expressions. Generators propose spans per kind: the base
patterns, and wider ones (obfuscated e-mails, grouped digits, phones without a
plus). A span gets yes/no features of its format and of the words before it.
Boosted trees of depth two are fitted to weak labels (checksums, digit counts,
telling words), over the counts of distinct feature rows: every round is two
aggregates, and only sums of gradients per feature come to the driver. Per kind
a threshold is calibrated to the share of weakly right candidates above it.

Valid base spans always count. A wider span counts if its score passes its
kind's threshold and it touches no base span; of wider spans that overlap the
best scored one counts.

Only texts with a digit or an at sign are searched further. Positions come from
running sums over the pieces between matches, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.llm.common import MIN_LONG, id_and_text, keyed
from ordermill.sources.shared import settle

KINDS = ("email", "ip", "card", "phone")

#: Patterns by kind. The base ones find the same spans as the plain forms of the
#: kinds' definitions; possessive parts and look-behinds only spare backtracking.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}[ ]?(?:@|\(at\)|\[at\])[ ]?[A-Za-z0-9-]{1,63}"
    r"(?:[ ]?(?:\.|\(dot\)|\[dot\])[ ]?[A-Za-z0-9-]{1,63}){1,5}",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){2,4}(?![0-9])",
}
#: Words before a span that tell its kind.
TELLING = {
    "email": "mail|contact|write|reach",
    "ip": r"\bip\b|host|server|address|addr",
    "card": "card|visa|credit|pay|iban",
    "phone": "tel|phone|call|fax|mobil",
}
CONTEXT = 24
ROUNDS = 6
RATE = 0.5
PENALTY = 1.0
PRECISION = 0.9


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(span: Column) -> Column:
    """Whether the span's digits pass the checksum."""
    digits = F.split(F.reverse(_digits(span)), "")

    def value(d: Column, i: Column) -> Column:
        twice = d.try_cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(
        F.transform(digits, value), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def _valid(kind: Column, span: Column) -> Column:
    """The definition's check on a base match."""
    n = F.length(_digits(span))
    parts = F.split(span, r"\.")
    small = F.forall(
        parts, lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        parts, lambda p: F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(999)) <= 255)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", _between(n, 13, 19) & _luhn(span))
        .otherwise(_between(n, 9, 15))
    )


def candidates(docs: DataFrame) -> DataFrame:
    """(k, t, kind, wide, start, end, span, before, after): proposed spans.

    ``k`` and ``t`` are id and text hash of the row; rows equal in both count
    once. ``start`` and ``end`` are code points, end exclusive.
    """
    rows = _rows(docs).filter(F.col("text").rlike("[0-9@]|[(\\[]at[)\\]]"))
    rows = rows.dropDuplicates(["k", "t"])
    found = []
    for wide, patterns in ((False, BASE), (True, WIDE)):
        for kind, pattern in patterns.items():
            found.append(F.struct(
                F.lit(kind).alias("kind"), F.lit(wide).alias("wide"),
                F.split("text", pattern, -1).alias("gaps"),
                F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hits")))
    each = rows.select("k", "t", "text", F.explode(F.array(*found)).alias("g")).filter(
        F.size("g.hits") > 0)
    tail = F.lit(CONTEXT)
    pieces = F.transform(
        "g.hits",
        lambda hit, i: F.struct(
            i.alias("i"), hit.alias("span"),
            F.length(F.get("g.gaps", i)).alias("gap"), F.length(hit).alias("size"),
            F.right(F.get("g.gaps", i), tail).alias("before"),
            F.left(F.get("g.gaps", i + 1), F.lit(1)).alias("after")))
    flat = each.select("k", "t", "g.kind", "g.wide", F.explode(pieces).alias("p")).select(
        "k", "t", "kind", "wide", "p.*")
    running = Window.partitionBy("k", "t", "kind", "wide").orderBy("i").rowsBetween(
        Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(running).cast("long")
    return flat.withColumn("end", end).select(
        "k", "t", "kind", "wide", (F.col("end") - F.col("size")).alias("start"), "end",
        "span", "before", "after")


def _rows(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumns(
        {"k": F.coalesce("doc_id", F.lit(MIN_LONG)), "t": F.xxhash64("text")})


def _features() -> dict[str, Column]:
    """Yes/no features of a candidate."""
    span, n = F.col("span"), F.length(_digits(F.col("span")))
    low = F.lower("before")
    out = {f"is_{kind}": F.col("kind") == kind for kind in KINDS[1:]}
    out |= {f"tells_{kind}": low.rlike(words) for kind, words in TELLING.items()}
    out |= {
        "wide": F.col("wide"),
        "digits_7": n >= 7, "digits_9": n >= 9, "digits_13": n >= 13,
        "digits_16": n >= 16, "digits_20": n >= 20,
        "blank": span.contains(" "), "dot": span.contains("."), "hyphen": span.contains("-"),
        "bracket": span.rlike(r"[(\[]"), "colon": span.contains(":"),
        "fours": span.rlike(r"^[0-9]{4}([^0-9][0-9]{4})+"),
        "large_part": span.rlike(r"(^|\.)0*(25[6-9]|2[6-9][0-9]|[3-9][0-9]{2}|[0-9]{4,})(\.|$)"),
        "luhn": _luhn(span),
        "letter_end": span.rlike(r"[.\])] ?[a-z]{2,6}$"),
        "glued_before": F.col("before").rlike(r"[A-Za-z0-9]$"),
        "glued_after": F.col("after").rlike(r"^[A-Za-z0-9]"),
    }
    return {name: F.coalesce(value, F.lit(False)) for name, value in out.items()}


def _weakly_right() -> Column:
    """The weak label: what the check says of a base match, telling signs of a wider one."""
    kind, span = F.col("kind"), F.col("span")
    n = F.length(_digits(span))
    telling = reduce(
        lambda a, k: a | ((kind == k) & F.lower("before").rlike(TELLING[k])), KINDS, F.lit(False))
    wider = (
        F.when(kind == "email", span.rlike(r"[a-z]{2,6}$"))
        .when(kind == "ip", F.length(F.regexp_replace(span, "[^:]", "")) == 7)
        .when(kind == "card", _luhn(span) & span.rlike("^[3-6]"))
        .otherwise(telling & _between(n, 9, 15))
    )
    return F.coalesce(F.when(F.col("wide"), wider).otherwise(_valid(kind, span)), F.lit(False))


@dataclass
class Trees:
    """Trees as expressions over feature columns, and the score each kind must pass."""

    score: Column
    thresholds: dict[str, float]


def fit(found: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION) -> Trees:
    """Boost depth-two trees on the candidates' weak labels, then calibrate.

    Without candidates, or without any right one of a kind, no wider span of
    the kind passes.
    """
    features = _features()
    names = list(features)
    table = settle(
        found.select("kind", *[c.alias(n) for n, c in features.items()], _weakly_right().alias("right"))
        .groupBy("kind", *names)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("right").alias("m")),
        "pii-patterns")
    score = F.lit(0.0)
    for _ in range(rounds):
        top = _best_split(table, score, names, {"all": F.lit(True)})["all"]
        if top is None:
            break
        split = F.col(top[0])
        leaves = _best_split(table, score, names, {"yes": split, "no": ~split})
        score = score + F.when(split, _leaf(leaves["yes"], top[1])).otherwise(
            _leaf(leaves["no"], top[2]))

    falling = Window.partitionBy("kind").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, 0)
    ranked = (
        table.groupBy("kind", F.round(score, 9).alias("score"))
        .agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        .withColumn("share", F.sum("m").over(falling) / (F.sum("n").over(falling) + 1))
        .filter(F.col("share") >= precision)
        .groupBy("kind").agg(F.min("score").alias("least"))
    )
    return Trees(score, {r.kind: r.least for r in ranked.collect()})


def _leaf(split: tuple | None, plain: float) -> Column:
    if split is None:
        return F.lit(plain)
    return F.when(F.col(split[0]), F.lit(split[1])).otherwise(F.lit(split[2]))


def _best_split(
    table: DataFrame, score: Column, names: list[str], parts: dict[str, Column]
) -> dict[str, tuple[str, float, float] | None]:
    """Per part the feature that lowers the loss most, with both leaves' steps."""
    p = F.col("p")
    table = table.withColumn("p", 1 / (1 + F.exp(-score))).withColumns(
        {"g": F.col("m") - F.col("n") * p, "h": F.col("n") * p * (1 - p)})
    g, h = F.col("g"), F.col("h")
    sums = {}
    for part, inside in parts.items():
        for name in names:
            sums[f"{part}.{name}.g"] = F.sum(F.when(inside & F.col(name), g))
            sums[f"{part}.{name}.h"] = F.sum(F.when(inside & F.col(name), h))
        sums[f"{part}..g"] = F.sum(F.when(inside, g))
        sums[f"{part}..h"] = F.sum(F.when(inside, h))
    row = table.agg(*[c.alias(k) for k, c in sums.items()]).first().asDict()
    out: dict[str, tuple[str, float, float] | None] = {}
    for part in parts:
        all_g, all_h = row[f"{part}..g"] or 0.0, row[f"{part}..h"] or 0.0
        best, out[part] = all_g**2 / (all_h + PENALTY) + 1e-9, None
        for name in names:
            yes_g, yes_h = row[f"{part}.{name}.g"] or 0.0, row[f"{part}.{name}.h"] or 0.0
            no_g, no_h = all_g - yes_g, all_h - yes_h
            gain = yes_g**2 / (yes_h + PENALTY) + no_g**2 / (no_h + PENALTY)
            if gain > best:
                best = gain
                out[part] = (
                    name, RATE * yes_g / (yes_h + PENALTY), RATE * no_g / (no_h + PENALTY))
    return out


def spans(docs: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION) -> DataFrame:
    """(k, t, kind, wide, start, end): the spans that count. Runs jobs."""
    found = settle(candidates(docs), "pii-candidates")
    trees = fit(found, rounds, precision)
    base = found.filter(~F.col("wide") & _valid(F.col("kind"), F.col("span")))
    passes = F.lit(False)
    for kind, least in trees.thresholds.items():
        passes |= (F.col("kind") == kind) & (F.round("score", 9) >= least)
    wider = (
        found.filter("wide").select("*", *[c.alias(n) for n, c in _features().items()
                                           if n != "wide"])
        .withColumn("score", trees.score).filter(passes)
        .select("k", "t", "kind", "start", "end", "score")
    )
    taken = base.groupBy("k", "t").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    free = wider.join(taken, ["k", "t"], "left").filter(
        ~F.exists(F.coalesce("taken", F.array().cast("array<struct<start:bigint,end:bigint>>")),
                  lambda b: (b.start < F.col("end")) & (F.col("start") < b.end)))
    return base.select("k", "t", "kind", "wide", "start", "end").union(
        apart(free).select("k", "t", "kind", F.lit(True).alias("wide"), "start", "end"))


def apart(spans: DataFrame) -> DataFrame:
    """(k, t, start, end, kind): of ``spans`` with a score, by falling score, each that
    overlaps none taken before it. Only spans of one chain of overlapping ones are compared.
    """
    order = Window.partitionBy("k", "t").orderBy("start", F.desc("end"))
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chain = F.sum(F.when(F.col("start") < F.col("reached"), 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    chained = spans.withColumn("reached", reached).withColumn("chain", chain)
    item = F.struct((-F.col("score")).alias("low"), "start", "end", "kind")
    ranked = chained.groupBy("k", "t", "chain").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def overlaps(taken: Column, span: Column) -> Column:
        return F.exists(taken, lambda b: (b.start < span.end) & (span.start < b.end))

    taken = F.aggregate(
        "items", F.filter("items", lambda s: F.lit(False)),
        lambda found, s: F.when(overlaps(found, s), found).otherwise(F.concat(found, F.array(s))))
    return ranked.select("k", "t", F.inline(taken)).drop("low")


def _listed(items: Column) -> Column:
    return F.array_join(
        F.transform(items, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))),
        ",")


def find(docs: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, added.

    The counts and the hash are of the valid base spans, written kind:start:end,
    by kind and start, joined by commas. ``spans`` lists all spans likewise,
    ``added`` counts those that the trees added. Null texts count as empty.
    """
    rank = reduce(
        lambda c, i: c.when(F.col("kind") == KINDS[i], i), range(1, 4), F.when(F.col("kind") == KINDS[0], 0))
    found = settle(spans(docs, rounds, precision), "pii-spans")
    item = F.struct(rank.alias("rank"), "start", "end", "kind", "wide")
    by_text = found.groupBy("k", "t").agg(F.array_sort(F.collect_set(item)).alias("all"))
    base = F.filter("all", lambda s: ~s.wide)
    counts = {f"n_{kind}": _of_kind(base, kind) for kind in KINDS}
    rows = _rows(docs).select("doc_id", "k", "t").join(by_text, ["k", "t"], "left").withColumn(
        "all", F.coalesce("all", F.filter(F.array(_no_span()), lambda s: F.lit(False))))
    return rows.select(
        "doc_id",
        *[c.cast("long").alias(n) for n, c in counts.items()],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        F.size(F.filter("all", lambda s: s.wide)).alias("added"),
    )


def _of_kind(items: Column, kind: str) -> Column:
    return F.size(F.filter(items, lambda s: s.kind == kind))


def _no_span() -> Column:
    return F.struct(
        F.lit(0).alias("rank"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("end"), F.lit("").alias("kind"), F.lit(False).alias("wide"))


def redact(docs: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets.

    Spans that overlap become one, named by the first. Rows, columns and their
    order stay as they are, null texts too; ``n_chars``, where there is such a
    column, follows a changed text.
    """
    found = settle(spans(docs, rounds, precision), "pii-spans").distinct()
    order = Window.partitionBy("k", "t").orderBy("start", F.desc("end"), "kind")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.col("start") < F.col("reached"), 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        found.withColumn("reached", reached).withColumn("group", group)
        .groupBy("k", "t", "group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"),
             F.min_by("kind", F.struct("start", "kind")).alias("kind"))
        .groupBy("k", "t")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    )
    cuts = F.col("__cuts")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda s: s.end))
    text = F.col("text")

    def piece(s: Column, i: Column) -> Column:
        at = F.get(ends, i)
        between = text.substr((at + 1).cast("int"), (s.start - at).cast("int"))
        return F.concat(between, F.lit("<"), F.upper(s.kind), F.lit(">"))

    last = F.element_at(ends, -1)
    rest = text.substr((last + 1).cast("int"), F.length(text))
    redacted = F.when(cuts.isNull(), text).otherwise(
        F.concat(F.array_join(F.transform(cuts, piece), ""), rest))
    # Written first: the planner takes the size of the spans' table for that of the cuts.
    settled = settle(
        merged.select(F.col("k").alias("__k"), F.col("t").alias("__t"), F.col("cuts").alias("__cuts")),
        "pii-cuts")
    joined = keyed(docs).join(settled, ["__k", "__t"], "left")
    changed = {"text": redacted}
    if "n_chars" in docs.columns:
        size = F.length(redacted).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(cuts.isNull(), F.col("n_chars")).otherwise(size)
    return joined.withColumns(changed).select(*docs.columns)
