"""Personal data by bootstrapped contextual extraction (operator 1).

DataFrame functions only. Seeds are the spans of four base patterns (email,
ip, card, phone) that pass their checks. Every other token with a digit or an
``@`` is an instance, known by its value; adjacent tokens of digits that are
joined by blanks, as in phone and card seeds, are one instance. Its coarse shape
(an ``@``; else whether it has letters, and up to 6, 7 to 12 or more digits)
joined to the one or two words before it is a lexical pattern.
Patterns and instances form a bipartite graph per kind, scored in rounds:

    confidence(pattern, kind) = (seeds of the kind + sum of instance scores)
                                / (all seeds + instances + 1)
    score(instance, kind) = 1 - product over patterns of (1 - confidence)

Seeds keep score 1 for their kind and 0 for others. A token inside a match
that failed its check (a number that fails the Luhn test, say) is a known
negative: it weighs against its patterns and is never discovered. Other
instances carry the partial score of their patterns from the first round on.
Only patterns that have ``min_seeds`` distinct seeds pass scores on; those that
reach ``min_confidence`` in the last round discover: an instance of such a
pattern becomes a span of that kind. Base spans always stay; discovered ones
never overlap them.

Positions are code points. A base pattern's matches are marked with a
character that no pattern accepts, the text is split at the marks, and the
lengths of the pieces are summed up in blocks, so a text with very many
matches costs no quadratic copying. The patterns are written so that a regex
engine needs no recursion or rescanning on very long runs.

Defined results: null texts count as empty and have no spans. Repeated rows
are judged alike; an instance seen twice counts once in the graph. An empty
table gives an empty result. Columns of the input keep their values; the
output's name gets an underscore where it clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, fresh, table

KINDS = ("email", "ip", "card", "phone")
MARK, PLAIN = "\x01", "\x02"

# The contract's patterns. Runs are possessive where what follows cannot give
# back, and a run is tried from its start (or from the last match) only.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+"}
# a token of digits (no IP address) that only closing punctuation may follow
DIGITS = (r"(?![0-9]++\.[0-9]++\.[0-9]++\.[0-9])[0-9](?:[().-]*+[0-9])*+\)?+"
          r"(?=[\p{P}&&[^@]]*+(?![^\x20\x09-\x0D]))")
# such tokens joined by blanks, or a whitespace-delimited token with a digit or @; tried from a token's start only
TOKEN = (r"(?<![^\x20\x09-\x0D])(?:[\p{P}&&[^@]]*+\+?+" + DIGITS + r"(?:\x20++(?:-\x20++)?+\(?+" + DIGITS + r")++"
         r"|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)")
BLOCK = 256
#: Code points before an instance that its context words are sought in.
CONTEXT = 64
SPAN = "struct<kind:int,start:bigint,end:bigint,value:string,before:string>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digits from the right: each second is doubled, 9 taken off above 9."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise((2 * d.cast("int")) - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(m)))  # null: too few or many digits for any card
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _with(value: Column, fn) -> Column:
    """``fn`` of ``value``, computed once."""
    return F.transform(F.array(value), fn)[0]


def _marked_spans(text: Column, pattern: str, kind: int, context: bool) -> Column:
    """array<SPAN> of the matches of ``pattern``: text between matches and
    matches alternate after the split."""
    pieces = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)
    span = F.struct

    def blocks(p: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / (2 * BLOCK)).cast("int"))
        return F.transform(starts, lambda b: F.slice(p, b * 2 * BLOCK + 1, F.lit(2 * BLOCK)))

    def local(block: Column) -> Column:
        """Length of a block, and its matches at places within the block."""
        pairs = F.sequence(F.lit(0), F.floor((F.size(block) - 1) / 2).cast("int"))
        zero = span(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

        def step(acc: Column, k: Column) -> Column:
            plain, match = F.get(block, 2 * k), F.get(block, 2 * k + 1)
            begin = acc["at"] + F.length(plain)
            end = begin + F.coalesce(F.length(match), F.lit(0))
            before = F.substring(plain, -CONTEXT, CONTEXT) if context else F.lit(None).cast("string")
            one = F.when(match.isNotNull(), F.array(span(
                F.lit(kind).alias("kind"), begin.cast("long").alias("start"), end.cast("long").alias("end"),
                match.alias("value"), before.alias("before")))).otherwise(F.array().cast(f"array<{SPAN}>"))
            return span(end.cast("long").alias("at"), F.concat(acc["found"], one).alias("found"))

        return F.aggregate(pairs, zero, step)

    def joined(done: Column) -> Column:
        zero = span(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("offsets"))
        offsets = F.aggregate(done, zero, lambda acc, b: span(
            (acc["at"] + b["at"]).alias("at"), F.concat(acc["offsets"], F.array(acc["at"])).alias("offsets")))["offsets"]
        return F.flatten(F.zip_with(done, offsets, lambda b, o: F.transform(b["found"], lambda s: span(
            s["kind"].alias("kind"), (s["start"] + o).alias("start"), (s["end"] + o).alias("end"),
            s["value"].alias("value"), s["before"].alias("before")))))

    done = _with(pieces, lambda p: F.transform(blocks(p), local))
    return _with(done, joined)


def matches(text: Column, kind: str) -> Column:
    """All matches of one kind in order of place; ``ok``: the check passes
    (null: the match is no number of that kind at all)."""
    found = F.transform(_marked_spans(text, PATTERNS[kind], KINDS.index(kind), context=True),
                        lambda s: s.withField("ok", _passes(kind, s["value"])))
    possible = text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike("[0-9]")
    return F.when(possible, found)


def _overlaps(s: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"]))


def annotate(df: DataFrame, text_col: str, names: tuple[str, str, str], keep_text: bool) -> DataFrame:
    """``df`` with a row number, base spans and other instances; one scan of
    the text, written once."""
    row, base, others = names
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), MARK, PLAIN)
    t, m = fresh(df, "pii_text", "pii_matches")
    none = F.array().cast(f"array<{SPAN[:-1]},ok:boolean>>")
    found = df.withColumn(t, text).withColumn(m, F.concat(*[F.coalesce(matches(F.col(t), k), none) for k in KINDS]))
    found = found.withColumn(base, F.filter(m, lambda s: s["ok"]))
    token = F.when(F.col(t).rlike("[0-9@]"), _marked_spans(F.col(t), TOKEN, -1, context=True))
    free = F.transform(F.filter(token, lambda s: ~_overlaps(s, F.col(base))),
                       lambda s: s.withField("ok", ~_overlaps(s, F.filter(m, lambda x: ~x["ok"]))))
    found = found.withColumn(others, F.coalesce(free, none)).drop(t, m)
    found = found.withColumn(row, F.monotonically_increasing_id())
    return cut(found if keep_text else found.drop(text_col), "pii")


def _shape(value: Column) -> Column:
    n = F.length(_digits(value))
    size = F.when(n < 7, "0-6").when(n < 13, "7-12").otherwise("13-")
    return F.when(value.contains("@"), "@").otherwise(F.concat(F.when(value.rlike(r"\p{L}"), "a").otherwise(""), size))


def _instances(annotated: DataFrame, row: str, col: str) -> DataFrame:
    """A row per span: its value without outer punctuation, and its patterns
    (context words before it, lower-cased, with its shape)."""
    s = annotated.select(row, F.explode(col).alias("s"))
    trimmed = F.regexp_replace("s.value", r"^[\p{P}&&[^+(@]]+|[\p{P}&&[^)]]+$", "")
    lead = F.length(F.regexp_extract("s.value", r"^[\p{P}&&[^+(@]]+", 0))
    words = F.filter(F.split(F.lower("s.before"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    s = s.select(F.col(row), F.col("s.kind").alias("kind"), F.col("s.ok").alias("ok"), trimmed.alias("value"), F.col("s.before").alias("before"),
                 (F.col("s.start") + lead).alias("start"), words.alias("words"))
    two = F.array_join(F.slice("words", -2, 2), " ")
    return s.filter("value <> ''").select(
        row, "kind", "ok", "value", "start", (F.col("start") + F.length("value")).alias("end"),
        F.when(F.size("words") >= 2, F.concat_ws("\x01", two, _shape(F.col("value")))).alias("two"),
        F.when(F.size("words") >= 1, F.concat_ws("\x01", F.element_at("words", -1), _shape(F.col("value")))).alias("one"))


def bootstrap(seeds: DataFrame, others: DataFrame, rounds: int, min_seeds: int, min_confidence: float) -> DataFrame:
    """(pattern, kind) of the patterns that discover. The graph's edges are
    distinct (value, pattern) pairs, so copies count once."""
    def edges(df: DataFrame, *keep: str) -> DataFrame:
        return df.select(*keep, "value", F.explode(F.array_compact(F.array("one", "two"))).alias("pattern"))

    seeded = edges(seeds, "kind").distinct()
    seed_side = seeded.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    per_pattern = seeded.groupBy("pattern").agg(F.count(F.lit(1)).alias("all_seeds"))
    # patterns without enough seeds can never pass a score on
    able = cut(seed_side.filter(F.col("seeds") >= min_seeds).join(per_pattern, "pattern"), "patterns")
    graph = cut(edges(others, "ok").distinct().join(able.select("pattern").distinct(), "pattern", "left_semi"), "graph")
    degree = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))  # negatives too
    able = able.join(degree, "pattern", "left").fillna(0, ["instances"])
    scores = None
    for _ in range(rounds):
        if scores is None:
            gained = able.withColumn("gain", F.lit(0.0))
        else:
            gain = graph.filter("ok").join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("gain"))
            gained = able.join(gain, ["pattern", "kind"], "left").fillna(0.0, ["gain"])
        confident = cut(gained.select("pattern", "kind", (
            (F.col("seeds") + F.col("gain")) / (F.col("all_seeds") + F.col("instances") + 1)).alias("confidence")), "confidence")
        # 1 - product(1 - confidence), as a sum of logarithms
        scores = graph.filter("ok").join(confident, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999)))))).alias("score"))
    best = F.max_by("kind", F.struct("confidence", -F.col("kind")))
    drop(able)
    return confident.filter(F.col("confidence") >= min_confidence).groupBy("pattern").agg(best.alias("kind"))


def find_pii(df: DataFrame, text_col: str = "text", out: str = "pii", rounds: int = 3, min_seeds: int = 3,
             min_confidence: float = 0.7, keep_text: bool = True) -> DataFrame:
    """``df`` with ``out``: array of (kind, start, end, value, base) by kind,
    then place."""
    row, base, others, o = fresh(df, "pii_row", "pii_base", "pii_others", out)
    seen = annotate(df, text_col, (row, base, others), keep_text)
    free = cut(_instances(seen, row, others), "instances")
    patterns = cut(bootstrap(_instances(seen, row, base), free, rounds, min_seeds, min_confidence), "discovering")
    free = free.filter("ok")
    by_two = free.join(patterns.withColumnRenamed("pattern", "two").withColumnRenamed("kind", "k"), "two")
    by_one = free.join(patterns.withColumnRenamed("pattern", "one").withColumnRenamed("kind", "k"), "one")
    spans = by_two.select(row, "start", "end", "value", "k").union(by_one.select(row, "start", "end", "value", "k"))
    one_each = spans.groupBy(row, "start", "end").agg(F.min("k").alias("kind"), F.first("value").alias("value"))
    new = F.struct(F.col("kind"), F.col("start"), F.col("end"), F.col("value"), F.lit(False).alias("base"))
    per_row = one_each.groupBy(F.col(row).alias("new_row")).agg(F.collect_list(new).alias("new"))
    old = F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                               s["value"].alias("value"), F.lit(True).alias("base")))
    kept = [c for c in df.columns if keep_text or c != text_col]
    both = seen.join(per_row, seen[row] == per_row["new_row"], "left")
    return both.select(*[seen[c] for c in kept], F.when(F.col("new").isNull(), old).otherwise(
        F.array_sort(F.concat(old, F.col("new")))).alias(o))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by ``<KIND>`` of
    its first span."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        new = F.when(s["start"] >= acc["at"], F.concat(gap, F.element_at(names, s["kind"] + 1))).otherwise("")
        return F.struct(F.concat(acc["done"], new).alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.aggregate(by_place, zero, step, lambda acc: F.concat(
        acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    base = F.filter("pii", lambda s: s["base"])

    def count(k: int) -> Column:
        return F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{KINDS[k]}")

    return found.select("doc_id", *[count(k) for k in range(len(KINDS))],
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"))
