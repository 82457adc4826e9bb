"""Personal data by bootstrapped contextual extraction. Native.

Seeds are the spans of four fixed patterns (mail addresses, IPv4 addresses, card
numbers that pass Luhn's test, telephone numbers). Every seed and every other
token that looks like an identifier is an instance (its string); the two words before
it (as far as the second hit of the same kind of search) and its shape (runs of letters and digits with their lengths) are its lexical
patterns. The graph of distinct (pattern, instance) pairs is scored in rounds: a pattern's
confidence is the trusted weight of its instances over all its instances, given
LEAST_SEEDS trusted ones and log-weighted support; an instance's confidence is
that of all its trusted patterns combined (1 - product of the doubts); instances
that reach TRUST join the trusted ones. A weight never falls, so the rounds come
to a fixed point: they end when the weights no longer move. Occurrences of
instances found that way are added with kind ``id``; seeds stay.

One pass over the texts writes spans and instances, without texts, to the shared
folder; graph and scores work on that table. Pairs are made distinct with
map-side aggregation, so a hot instance or pattern meets the shuffle once per
task. Positions are code points: lengths of the gaps and hits that split and
extraction with one pattern give, summed in blocks of BLOCK hits.

Edge cases: NULL and empty texts have no spans; rows repeat as they come (each
has its spans); an empty table gives an empty result; columns beyond doc_id and
text are ignored. The patterns are written so that matching takes time in
proportion to the text: possessive where nothing can follow, and starting only
at the first sign of a run or where the last match ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, SPACE, let, text_of, written

# The base patterns, with the bounds in the functions below.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone", "id")
CANDIDATE = r"[A-Za-z0-9][A-Za-z0-9@._%+()/:-]{4,}(?<=[A-Za-z0-9])"
LEAST_DIGITS = 4
BLOCK = 64
LONG_WORD = 64             # longer words of a context go by their digest
LEAST_SEEDS, PATTERN_TRUST, TRUST, STILL = 5, 0.5, 0.8, 1e-6
MAX_BROADCAST_BYTES = 64_000_000

SPAN = "array<struct<start:int,end:int,hit:string,left:array<string>>>"


def last_words(gap: Column) -> Column:
    """The last two words of a gap, whole, in lower case (fewer if it has fewer)."""
    return let(F.btrim(gap, F.lit(BLANKS)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.transform(let(F.split(F.lower(t), SPACE), lambda w: F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), F.lit(2))),
                    lambda w: F.when(F.length(w) > LONG_WORD, F.concat(F.lit("#"), F.sha2(w.cast("binary"), 256))).otherwise(w))))


def spans(text: Column, pattern: str, only_if: Column, wanted=lambda hit: F.lit(True)) -> Column:
    """array of (start, end, hit, left) of the pattern's matches, in order;
    ``left``: the two words before, of ``wanted`` hits."""
    none = F.array().cast(SPAN)

    def placed(steps: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
        length = lambda part: F.aggregate(part, F.lit(0), lambda a, s: a + s["g"] + s["h"])
        sums = F.transform(blocks, lambda b: length(F.slice(steps, b * BLOCK + 1, BLOCK)))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        offsets = F.aggregate(sums, zero, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
                              lambda a: a["out"])

        def block(offset: Column, b: Column) -> Column:
            return let(F.slice(steps, b * BLOCK + 1, BLOCK), lambda part: F.transform(
                part, lambda s, i: let(offset + length(F.slice(part, F.lit(1), i)) + s["g"], lambda at: F.struct(
                    at.alias("start"), (at + s["h"]).alias("end"), s["hit"].alias("hit"), s["left"].alias("left")))))
        return F.flatten(let(offsets, lambda o: F.transform(o, block)))

    def stepped(gaps: Column, hits: Column) -> Column:
        # the words before a hit are read from the second hit before it on
        at = lambda parts, i: F.coalesce(F.get(parts, i), F.lit(""))
        before = lambda i: F.concat(at(hits, i - 2), F.when(i > 0, at(gaps, i - 1)).otherwise(""), at(hits, i - 1), at(gaps, i))
        steps = F.transform(hits, lambda h, i: F.struct(
            F.length(at(gaps, i)).alias("g"), F.length(h).alias("h"), h.alias("hit"),
            F.when(wanted(h), last_words(before(i))).otherwise(F.array().cast("array<string>")).alias("left")))
        return F.when(F.size(hits) == 0, none).otherwise(let(steps, placed))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda hits: F.when(F.size(hits) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda gaps: stepped(gaps, hits))))
    return F.when(only_if, found).otherwise(none)


def luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        v = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(t: Column) -> dict[str, Column]:
    """The seeds of a text, per kind."""
    digits = lambda hit: F.regexp_replace(hit, "[^0-9]", "")
    has_digit = t.rlike("[0-9]")
    card = lambda s: let(digits(s["hit"]), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    return {
        "email": spans(t, EMAIL, t.contains("@")),
        "ip": F.filter(spans(t, IP, has_digit & t.contains(".")), lambda s: s["hit"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        "card": F.filter(spans(t, CARD, has_digit), card),
        "phone": F.filter(spans(t, PHONE, t.contains("+")), lambda s: F.length(digits(s["hit"])).between(10, 15)),
    }


def shape(hit: Column) -> Column:
    """A string's shape: capitals A, small letters a, digits 9, each run with its length class."""
    flat = F.regexp_replace(F.regexp_replace(F.regexp_replace(hit, r"[0-9]", "9"), r"[\p{Lu}]", "A"), r"[\p{L}&&[^A]]", "a")
    return F.regexp_replace(flat, r"(a)\1{3,}", "a+")


def instances(kind: str, found: Column) -> Column:
    """(inst, kind, start, end, patterns) of spans: two words before, one word before, shape."""
    def one(s: Column) -> Column:
        return let(s["left"], lambda w: F.struct(
            s["hit"].alias("inst"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.array_compact(F.array(
                F.when(F.size(w) >= 2, F.concat(F.lit("2:"), F.array_join(w, " "))),
                F.when(F.size(w) >= 1, F.concat(F.lit("1:"), F.element_at(w, -1))),
                F.concat(F.lit("s:"), shape(s["hit"])))).alias("patterns")))
    return F.transform(found, one)


def observed(docs: DataFrame) -> DataFrame:
    """One row per document: rid, doc_id, seeds and the other candidates."""
    t = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_of().alias("t"))
    t = t.withColumns({f"s_{k}": c for k, c in base_spans(F.col("t")).items()})
    seeds = F.concat(*[instances(k, F.col(f"s_{k}")) for k in KINDS[:4]])
    t = t.withColumn("seeds", seeds)
    digits = lambda hit: hit.rlike("(?:[0-9][^0-9]*+){%d}" % LEAST_DIGITS)
    found = F.filter(spans(F.col("t"), CANDIDATE, F.col("t").rlike("[0-9]"), digits), lambda s: digits(s["hit"]))
    others = let(found, lambda c: without_overlap(c, F.col("seeds"), F.length("t")))
    return t.select("rid", "doc_id", "seeds", instances("id", others).alias("others"))


def without_overlap(found: Column, seeds: Column, length: Column) -> Column:
    """The spans ``found`` that touch no seed. The text is cut into as many blocks
    as the root of the number of spans, and a span meets the seeds of its blocks only."""
    def free(width: Column, blocks: Column) -> Column:
        def touched(s: Column) -> Column:
            first = F.floor(s["start"] / width).cast("int")
            last = F.floor((s["end"] - 1) / width).cast("int")
            return F.exists(F.slice(blocks, first + 1, last - first + 1), lambda b: F.exists(b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))
        return F.filter(found, lambda s: ~touched(s))

    def cut(n: Column) -> Column:
        return let(F.greatest(F.ceil(length / n), F.lit(1)).cast("int"), lambda width: let(
            F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.filter(seeds, lambda x: (x["start"] < (b + 1) * width) & (x["end"] > b * width))),
            lambda blocks: free(width, blocks)))
    return F.when((F.size(found) == 0) | (F.size(seeds) == 0), found).otherwise(let(F.ceil(F.sqrt(F.size(found))).cast("int"), cut))


def broadcast_small(df: DataFrame, name: str) -> DataFrame:
    """``df`` hinted for broadcast if its strings ``name`` and numbers, measured, are few bytes."""
    size = df.agg(F.sum(F.octet_length(name) + 32)).first()[0] or 0
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df


def bootstrap(edges: DataFrame) -> DataFrame:
    """inst, score of the instances found. ``edges``: distinct (pattern, inst, seed)."""
    nodes = written(edges.groupBy("inst").agg(F.max(F.col("seed").cast("double")).alias("weight")), "pii-nodes")
    first, total = nodes, None
    size = written(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_SEEDS), "pii-sizes")
    while True:
        now = nodes.agg(F.sum("weight")).first()[0] or 0.0
        if total is not None and now - total <= STILL:
            break
        total = now
        known = nodes.where("weight > 0")
        trust = (edges.join(known, "inst").groupBy("pattern").agg(F.sum("weight").alias("known"))
                 .where(F.col("known") >= LEAST_SEEDS).join(size, "pattern")
                 .select("pattern", (F.col("known") / F.col("n") * (1 - 1 / F.log2(F.col("known") + 1) / 4)).alias("conf"))
                 .where(F.col("conf") >= PATTERN_TRUST))
        trust = broadcast_small(written(trust, "pii-patterns"), "pattern")
        best = (edges.join(trust, "pattern").groupBy("inst").agg((1 - F.exp(F.sum(F.log1p(-F.least("conf", F.lit(0.99)))))).alias("found"))
                .where(F.col("found") >= TRUST))
        nodes = written(nodes.join(best, "inst", "left").select("inst", F.greatest("weight", F.coalesce("found", F.lit(0.0))).alias("weight")), "pii-nodes")
    return nodes.join(first.where("weight = 0").select("inst"), "inst").where(F.col("weight") >= TRUST).withColumnRenamed("weight", "score")


def listed(found: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    order = F.array(*[F.lit(k) for k in KINDS])
    rows = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"),
                                                              s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, seeds and found, arrays of (kind, start, end, inst, score)."""
    rows = written(observed(docs), "pii-rows")
    both = F.concat(F.transform("seeds", lambda s: F.struct(s["inst"].alias("inst"), s["patterns"].alias("patterns"), F.lit(True).alias("seed"))),
                    F.transform("others", lambda s: F.struct(s["inst"].alias("inst"), s["patterns"].alias("patterns"), F.lit(False).alias("seed"))))
    edges = (rows.select(F.explode(both).alias("e")).select(F.explode("e.patterns").alias("pattern"), "e.inst", "e.seed")
             .groupBy("pattern", "inst").agg(F.max("seed").alias("seed")))
    found = broadcast_small(written(bootstrap(written(edges, "pii-edges")), "pii-found"), "inst")
    hits = (rows.select("rid", F.explode("others").alias("s")).join(found, F.col("s.inst") == F.col("inst"))
            .groupBy("rid").agg(F.collect_list(F.struct(F.col("s.kind").alias("kind"), F.col("s.start").alias("start"),
                                                        F.col("s.end").alias("end"), F.col("s.inst").alias("inst"), "score")).alias("found")))
    plain = F.transform("seeds", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                    s["inst"].alias("inst"), F.lit(1.0).alias("score")))
    return (rows.join(hits, "rid", "left")
            .select("doc_id", plain.alias("seeds"), F.coalesce("found", F.array().cast(
                "array<struct<kind:string,start:int,end:int,inst:string,score:double>>")).alias("found")))


def digest(found: DataFrame) -> DataFrame:
    """Counts, base_sha256 and spans from ``personal_data``."""
    count = lambda k: F.size(F.filter("seeds", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(listed(F.col("seeds")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.concat("seeds", "found")).alias("spans"))
