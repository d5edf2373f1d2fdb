"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Every source has a target number of words; a document of it is wanted
``target / source size`` times, a number with a fraction.  The whole part is taken
for certain.  The fractions are rounded dependently: two documents of a source meet,
words of wanted mass move from one to the other, in a random direction whose odds
leave each document's expectation as it was, until one of the two is wanted
wholly or not at all.  The other goes on.  So a source's words stay what they were
in sum, and only the last document standing is rounded on its own.

The meetings form a reduction tree.  Documents are grouped by source and size class
(powers of two) and dealt by hash to groups of about ``GROUP``; a group is one fold
over a small sorted array and leaves one residual.  Residual groups are combined
``GROUP`` at a time until each class has one; the residuals of a source's classes
meet last, the longest first, so what remains is mostly short.  A source that holds a
third of all rows is as many groups as its documents need; no task ever holds more
than a group.  Every level is written once, so a lost executor costs one level.

All draws are hashes of ids and sizes: reruns agree, whatever the partitioning.
Rows of equal id, source and size cannot be told apart in the result; they are
one unit of the tree with a multiplicity, of which at most one row is fractional.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import let, written
from tierlake.operators.upsert import dense_sequence

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 32
#: Rows that one expanding step makes of a repeated row.
RUN = 4096

_UNIT = "struct<h:bigint,doc_id:bigint,size:bigint,m:bigint,base:bigint,certain:bigint,mass:double>"
_DONE = "struct<doc_id:bigint,size:bigint,m:bigint,base:bigint,certain:bigint,up:boolean>"


def hashed(seed: int, *parts: Column) -> Column:
    """52 bits of SHA-256 over the seed and the parts as text; NULL is an empty part."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``sources(key, source, source_size)`` with ``target``.

    The weights go round the sources in code-point order, NULL last.  All targets together are ``share`` of all
    words.  A target stops at ``most`` times its source's size and the excess is shared anew by weight among the
    others, until none is above: each round is one row of sums, and the rounds end because a stopped source stays
    stopped.  Sources without words get 0.
    """
    listed = dense_sequence(sources.withColumn("last", F.col("source").isNull()), ["last", "source"], name="place").drop("last")
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1
    listed = written(listed.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).cast("double")), "mix-sources")
    cap = F.col("source_size") * most
    words = listed.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    unit, stopped = 0.0, -1
    while words:
        above = F.col("weight") * unit >= cap
        r = listed.agg(F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if r["n"] == stopped or not r["open"]:
            break
        stopped, unit = r["n"], (share * words - r["held"]) / r["open"]
    return listed.withColumn("target", F.least(F.col("weight") * unit, cap.cast("double"))).drop("weight", "place")


def _met(seed: int, state: Column, other: Column) -> Column:
    """One meeting: the state with one unit more that is decided, and the unit that goes on."""
    def meet(p: Column) -> Column:
        i, j = p["i"], p["j"]
        room_i, room_j = i["size"] - i["mass"], j["size"] - j["mass"]
        to_i, to_j = F.least(room_i, j["mass"]), F.least(i["mass"], room_j)
        u = hashed(seed, F.lit("meet"), i["doc_id"], i["size"], j["doc_id"], j["size"]) / float(1 << 52)

        def outcome(first: Column) -> Column:
            fills = room_i <= j["mass"]       # words go to i: i is full, or j is empty
            drains = i["mass"] <= room_j      # words go to j: i is empty, or j is full
            i_ends = F.when(first, fills).otherwise(drains)
            mass = (F.when(first & fills, j["mass"] - room_i).when(first, i["mass"] + j["mass"])
                    .when(drains, i["mass"] + j["mass"]).otherwise(i["mass"] - room_j))
            ended, going = F.when(i_ends, i).otherwise(j), F.when(i_ends, j).otherwise(i)
            return F.struct(F.concat(p["done"], F.array(_done(ended, first == i_ends))).alias("done"),
                            _unit(going, mass).alias("unit"))

        return let(u * (to_i + to_j) < to_j, outcome)

    return let(F.struct(state["unit"].alias("i"), other.alias("j"), state["done"].alias("done")), meet)


def _done(unit: Column, up: Column) -> Column:
    return F.struct(*[unit[c].alias(c) for c in ("doc_id", "size", "m", "base", "certain")], up.alias("up")).cast(_DONE)


def _unit(unit: Column, mass: Column) -> Column:
    return F.struct(*[unit[c].alias(c) for c in ("h", "doc_id", "size", "m", "base", "certain")], mass.alias("mass")).cast(_UNIT)


def _folded(groups: DataFrame, seed: int) -> DataFrame:
    """``groups(..., units)`` with ``state``: all units but one decided, one that goes on."""
    kind = f"struct<done:array<{_DONE}>,unit:{_UNIT}>"
    start = F.struct(F.array().cast(f"array<{_DONE}>").alias("done"), F.get("units", F.lit(0)).alias("unit")).cast(kind)
    rest = F.slice("units", F.lit(2), F.greatest(F.size("units") - 1, F.lit(0)))
    return groups.withColumn("state", F.aggregate(rest, start, lambda state, other: _met(seed, state, other).cast(kind))).drop("units")


def _decided(level: DataFrame) -> DataFrame:
    return level.select("source_size", "target", F.inline("state.done"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken``: how often the mix takes each document.

    ``size`` is the number of words (``WORD``), ``taken`` = ``copies * size``.  A document is taken the whole part
    of ``target / source_size`` times or once more, so never more than ``most`` times, and a source's taken words
    miss its target by less than one document's size.  One row per row of ``docs``.

    NULL texts have size 0; NULL sources are one source, listed last; NULL ids are an id.  Rows of equal id, source
    and size share their copies out among them as one unit.  Documents without words are taken 0 times.  Sizes may
    be of any length.  An empty table gives an empty result.  Other columns, whatever their names, are left out.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    source = F.col(source_col).cast("string")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), source.alias("source"), key.alias("key"), size.alias("size"))
    units = written(rows.groupBy("doc_id", "source", "key", "size").agg(F.count(F.lit(1)).alias("m"))
                    .withColumn("class", F.length(F.bin("size"))), "mix-units")
    classes = units.groupBy("key", "source", "class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") * F.col("m")).alias("words"))
    classes = written(classes, "mix-classes")
    wanted = targets(classes.groupBy("key", "source").agg(F.sum("words").alias("source_size")), weights, share, most)
    groups = F.ceil(F.col("n") / GROUP)
    classes = written(classes.join(wanted.drop("source"), "key").select("key", "class", "source_size", "target", groups.alias("groups")), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    dealt = units.drop("source").join(classes, ["key", "class"]).withColumn("base", F.floor(rate)) \
        .withColumn("extra", F.when(F.col("size") > 0, (rate - F.col("base")) * F.col("m")).otherwise(0.0)) \
        .withColumn("certain", F.floor("extra")).withColumn("part", F.col("extra") - F.col("certain"))
    whole = dealt.where("part = 0").select("source_size", "target", "doc_id", "size", "m", "base", "certain", F.lit(None).cast("boolean").alias("up"))
    unit = F.struct(hashed(seed, F.lit("deal"), F.col("key"), F.col("doc_id"), F.col("size")).alias("h"), "doc_id", "size", "m", "base", "certain",
                    (F.col("part") * F.col("size")).alias("mass")).cast(_UNIT)
    now = dealt.where("part > 0").select("key", "class", "source_size", "target", "groups", unit.alias("unit")) \
        .withColumn("group", F.pmod(F.col("unit.h"), F.col("groups")))
    left = classes.agg(F.max("groups").alias("n")).first()["n"] or 0
    done = [whole]
    kept = [F.max(c).alias(c) for c in ("source_size", "target", "groups")]
    while left:
        now = now.groupBy("key", "class", "group").agg(*kept, F.sort_array(F.collect_list("unit")).alias("units"))
        now = written(_folded(now, seed), "mix-level")
        done.append(_decided(now))
        left = 0 if left == 1 else -(-left // GROUP)
        now = now.withColumn("unit", F.col("state.unit")).drop("state") \
            .withColumn("group", F.floor(F.col("group") / GROUP)).withColumn("groups", F.ceil(F.col("groups") / GROUP))
    by_size = F.sort_array(F.collect_list(F.struct((-F.col("unit.size")).alias("s"), "unit")))
    last = now.groupBy("key").agg(*kept, F.transform(by_size, lambda x: x["unit"]).alias("units"))
    last = written(_folded(last, seed), "mix-last")
    final = F.col("state.unit")
    taken = hashed(seed, F.lit("last"), F.col("key"), final["doc_id"], final["size"]) / float(1 << 52) * final["size"] < final["mass"]
    done += [_decided(last), last.select("source_size", "target", F.inline(F.array(_done(final, taken))))]
    for k, part in enumerate(done):
        found = part if not k else found.unionByName(part)
    return _rows(found)


def _rows(units: DataFrame) -> DataFrame:
    """One row per document of decided units; a unit of many rows is expanded in runs that other tasks take over."""
    names = ["doc_id", "size", "source_size", "target", "copies"]
    extra = F.coalesce(F.col("up").cast("long"), F.lit(0).cast("long"))
    single = units.where("m = 1").withColumn("copies", F.col("base") + F.col("certain") + extra)
    some = F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long")
    parts = F.array(F.struct(some.alias("n"), (F.col("base") + extra).alias("copies")),
                    F.struct(F.col("certain").alias("n"), (F.col("base") + 1).alias("copies")),
                    F.struct((F.col("m") - F.col("certain") - some).alias("n"), F.col("base").alias("copies")))
    runs = units.where("m > 1").select("doc_id", "size", "source_size", "target", F.inline(parts)).where("n > 0") \
        .withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long")))) \
        .repartition("doc_id", "at", "copies") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("n") - F.col("at"), F.lit(RUN).cast("long")))))
    both = single.select(*names).unionByName(runs.select(*names))
    return both.withColumn("taken", F.col("copies") * F.col("size"))
