"""Mixing sources to target weights by Poisson replication.

Each source s has a target weight; its mean repetition rate is the tokens (here code points) it
should contribute over those it has: rate_s = total * weight_s / mass_s.  Every document draws its
number of copies by inverting the Poisson distribution of that mean at a uniform number hashed
from the seed, the document's id and its text: no state, no random generator, the same draw on every
run and after a lost executor.  Rows equal in both are told apart by their place in the scan (such
keys are counted first; there are few or none), so each draws for itself and a hot id spreads.
Copies are exploded and shuffled globally on a hash of (seed, id, text, copy): each copy goes to a uniformly random partition and rows are sorted by the hash within it, which is
a uniformly random order without a sampling pass.

Target weights default to mass^ALPHA (temperature sampling); explicit weights are a dict.

Cases: null sources are one source; a null id hashes as the word ``null``; rows repeating an id, or
without one, draw each for itself; a null text hashes as the empty one; null or empty texts count one code point; a source without weight
(explicit weights) has rate 0 and leaves; an empty table gives an empty result.  Extra columns are
carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import packed, quoted, unpacked
from ratewise.sources.tables import cut_lineage

ALPHA = 0.7     # target weight of a source: mass ** ALPHA
SEED = 17
SCALE = 2.0 ** 52
PIECE = 500.0   # a larger rate is drawn as a sum of equal Poisson pieces of at most this mean
BROADCAST_SOURCES = 10_000   # the rates are broadcast below this measured number of sources
BROADCAST_REPEATS = 500_000  # keys that several rows share are broadcast below this measured number


def uniform(*parts: Column) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of an md5, the same in any SQL engine."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(SCALE)


def poisson_cdf(rate: Column) -> Column:
    """Cumulative probabilities 0..K, K beyond any 52-bit uniform number's reach (rate <= PIECE)."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    kind = "struct<p:double,c:array<double>>"
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c")).cast(kind)

    def step(a, k):
        p = a["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(a["c"], F.array(F.element_at(a["c"], -1) + p)).alias("c")).cast(kind)

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["c"]


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA,
                 source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(source, mass, rate)``: one row per source, rates that keep the total mass."""
    mass = (docs.groupBy(quoted(source_col).alias("source"))
            .agg(F.sum(F.greatest(F.coalesce(F.char_length(quoted(text_col)), F.lit(0)), F.lit(1)).cast("long")).alias("mass")))
    if weights is None:
        weighted = mass.withColumn("weight", F.pow(F.col("mass").cast("double"), F.lit(alpha)))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "wsource string, weight double")
        weighted = (mass.join(given, F.col("source").cast("string").eqNullSafe(F.col("wsource")), "left")
                    .select("source", "mass", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    tm, tw = weighted.agg(F.sum("mass")).scalar(), weighted.agg(F.sum("weight")).scalar()
    return weighted.select("source", "mass", F.when(tw > 0, tm * F.col("weight") / tw / F.col("mass")).otherwise(0.0).alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = ALPHA, seed: int = SEED,
        source_col: str = "source", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(_row, copy, rate, shuffle_key)``: the replicated rows in their global random order."""
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    rates = cut_lineage(source_rates(docs, weights, alpha, source_col, text_col).select(
        F.col("source").alias("_source"), "rate", pieces.alias("pieces"), poisson_cdf(F.col("rate") / pieces).alias("cdf")))
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)      # else joined by shuffle, skew split by adaptive execution
    text, name = F.coalesce(quoted(text_col), F.lit("")), F.coalesce(quoted(id_col).cast("string"), F.lit("null"))
    own = docs.select(name.alias("_ri"), F.xxhash64(text).alias("_rt"))
    repeats = cut_lineage(own.groupBy("_ri", "_rt").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_ri", "_rt"))
    if repeats.count() <= BROADCAST_REPEATS:
        repeats = F.broadcast(repeats)
    rows = docs.select(packed(docs), quoted(source_col).alias("_src"), name.alias("_i"), F.xxhash64(text).alias("_t"),
                       F.concat_ws(":", name, F.md5(text)).alias("_k"), F.monotonically_increasing_id().alias("_place"))
    # equal rows get their place in the scan as well
    rows = rows.join(repeats, (rows["_i"] == repeats["_ri"]) & (rows["_t"] == repeats["_rt"]), "left").select(
        "_row", "_src", F.when(F.col("_ri").isNull(), F.col("_k")).otherwise(F.concat_ws(":", "_k", "_place")).alias("_id"))

    def draw(piece: Column) -> Column:
        u = uniform(F.lit(seed), F.col("_id"), piece)
        return F.size(F.filter("cdf", lambda c: c <= u))

    count = F.when(F.col("pieces") == 1, draw(F.lit(0))).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.col("pieces") - 1), F.lit(0), lambda a, i: a + draw(i)))
    drawn = rows.join(rates, rows["_src"].eqNullSafe(rates["_source"])).withColumn("copies", count).filter("copies > 0")
    copies = drawn.select("_row", "_id", "rate", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.lit("order"), F.col("_id"), F.col("copy").cast("string"))))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (keyed.select("_row", "copy", "rate", "shuffle_key").repartition(n, "shuffle_key")
            .sortWithinPartitions("shuffle_key", "copy"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: ``docs``' columns, rows repeated and shuffled."""
    return unpacked(mix(docs, **options), docs.columns)
