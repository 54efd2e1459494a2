"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, seeded choice of blocks.

1. Every source has a weight; the weights share the wanted words. A source whose share is
   more than CAP times what it has stops there, and the excess is shared by the others.
2. Words are counted in blocks of BLOCK. The blocks go to the sources by highest quotients
   (target / 1, 3, 5, ...): integer quotas that sum up.
3. A source's documents are dealt, by a seeded hash, to shards of about SHARD words, as
   many as its size asks for, so that a source with a third of all words is many shards.
   Its quota goes to its shards by the same rule, by the words that each has.
4. In a shard the documents stand in seeded order, one after another, and are cut into
   blocks. A quota of at least all blocks takes each once; what is left of it picks as many
   blocks by a seeded permutation of their numbers. No block list is shuffled: a document
   tells from its place which blocks cover it.

The highest quotients are found without gathering the parties: with n parties and K seats
the divisor lies between those of K - n/2 and K + n/2 seats, so all but about 4 n seats are
decided by arithmetic; only these are ranked, over all tasks (`places.numbered`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.places import numbered
from tidemark.session import write_and_read

NAME = "op11_source_mix"

#: words of a block
BLOCK = 16
#: words of a shard, about
SHARD = 1 << 18
SEED = "mix"
#: fixed values: the contract's weights by place of the source, share of all words, and cap of a source
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: primes above the blocks of any shard; one multiplies block numbers, modulo the blocks of the shard
MULTIPLIERS = (1327217909, 1621087453, 1759159639, 1223722711)


def count_words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def seeded(*parts: Column | str) -> Column:
    """A number below 2**60 from the MD5 of the parts, told apart from null ones."""
    texts = [F.coalesce(F.concat(F.lit("="), (F.lit(p) if isinstance(p, str) else p).cast("string")), F.lit("-")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("/", *texts)), 1, 15), 16, 10).cast("long")


def shared_out(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """`sources` (_source, _size, _at: its place) with _target. Every round sums the sources at their cap and the weights of
    the others; a source that is at its cap stays there, as the level only rises."""
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.col("_at") % len(weights)).cast("int")]
    table = write_and_read(sources.withColumn("_weight", weight), "mix-sources")
    total = table.agg(F.sum("_size")).first()[0] or 0
    level, before = 0.0, None
    while before != level:
        before = level
        at_cap = F.col("_weight") * level >= cap * F.col("_size")
        full, rest = table.agg(F.sum(F.when(at_cap, F.col("_size"))), F.sum(F.when(~at_cap, F.col("_weight")))).first()
        if rest:
            level = max(level, (share * total - cap * (full or 0)) / rest)
    top = cap * F.col("_size").cast("double")
    return table.withColumn("_target", F.least(F.col("_weight") * F.lit(level), top)).drop("_weight")


def apportion(parties: DataFrame, group: str, votes: str, seats: str, order: Sequence[str]) -> DataFrame:
    """`parties` with _quota: the seats of each group (column `seats`) go one by one to the party with the highest
    votes / (2 k + 1), k being what it has; equal quotients by `order`. Exact, in doubles."""
    v, k = F.col(votes).cast("double"), F.col(seats)
    parties = write_and_read(parties, "mix-parties")
    sums = parties.groupBy(F.col(group).alias("_in")).agg(F.sum(v).alias("_sum"), F.count("*").alias("_parties"))
    known = parties.join(sums, F.col(group) == F.col("_in")).drop("_in")

    def about(half: float) -> Column:
        return F.round(v * (k + half * F.col("_parties")) / F.col("_sum")).cast("long")

    nothing = (F.col("_sum") <= 0) | (k <= 0)
    low = F.when(nothing, F.lit(0)).otherwise(F.greatest(about(-0.5) - 1, F.lit(0)))
    high = F.when(nothing, F.lit(0)).otherwise(F.greatest(about(0.5) + 1, F.lit(0)))
    known = write_and_read(known.withColumns({"_low": low.cast("long"), "_high": high.cast("long")}), "mix-known")
    open_seats = known.groupBy(F.col(group).alias("_in")).agg((F.first(seats) - F.sum("_low")).alias("_open"))
    bids = known.where("_high > _low AND " + f"{votes} > 0").select(
        group, *order, v.alias("_votes"), F.explode(F.sequence(F.col("_low"), F.col("_high") - 1)).alias("_k")
    )
    bids = bids.withColumn("_worse", -(F.col("_votes") / (2 * F.col("_k") + 1))).drop("_votes", "_k")
    ranked = numbered(bids, group, ["_worse", *order], "mix-bids")
    won = ranked.join(open_seats, F.col(group) == F.col("_in")).where("_pos < _open")
    won = won.groupBy(*[F.col(c).alias(f"_at_{c}") for c in dict.fromkeys([group, *order])]).agg(F.count("*").alias("_won"))
    same = [F.col(c) == F.col(f"_at_{c}") for c in dict.fromkeys([group, *order])]
    met = known.join(won, same, "left")
    return met.select(*parties.columns, (F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))).alias("_quota"))


@dataclass
class Mix:
    """sources: _source, _size, _target, _quota (blocks); shards: _at (the source's place), _shard, _words, _blocks, _quota;
    documents: the carried columns, size, source_size, target, _at, _shard, _start (words before it in its shard),
    _words, _blocks, _quota, _block (words of a block), taken."""

    sources: DataFrame
    shards: DataFrame
    documents: DataFrame


def _picked(block: Column) -> Column:
    """Is the block among those of the quota's rest?"""
    primes = F.array(*[F.lit(p).cast("long") for p in MULTIPLIERS])
    which = F.col("_salt") % len(MULTIPLIERS)
    return (block * primes[which.cast("int")] + F.col("_salt") % F.col("_blocks")) % F.col("_blocks") < F.col("_quota") % F.col("_blocks")


def _covering() -> Column:
    """The blocks that cover a document of at least one word: number, first word inside the document, words."""
    first, last = F.col("_start"), F.col("_start") + F.col("size") - 1
    numbers = F.sequence(F.floor(first / F.col("_block")), F.floor(last / F.col("_block")))

    def piece(b: Column) -> Column:
        begin = F.greatest(b * F.col("_block"), first)
        end = F.least((b + 1) * F.col("_block"), last + 1)
        copies = F.floor(F.col("_quota") / F.col("_blocks")) + _picked(b).cast("long")
        return F.struct(b.alias("block"), (begin - first).alias("first_word"), (end - begin).alias("n_words"), copies.alias("copies"))

    return F.when(F.col("size") > 0, F.transform(numbers, piece)).otherwise(F.array())


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: str = SEED,
    carry: Sequence[str] = (),
) -> Mix:
    """Quotas and what is taken of each document, for `share` of all words, at most `cap` times each.

    Weights go by the sources' place in code point order, null last, and repeat. A null text has no words; a document
    without words takes nothing; a source without words has target 0. The order inside a shard is that of the seeded
    hash of `key`, then of `key` and size, so reruns agree, and rows that agree in all three may change places only
    with each other. A source's words come within a block or two for each of its shards of its target.
    Columns of `docs` that are not in `carry` are left out.
    """
    kept = list(dict.fromkeys([key, *carry]))
    sized = docs.select(*kept, F.col(source).alias("_source"), count_words(F.col(text)).alias("size"))
    sized = write_and_read(sized.withColumn("_hash", seeded(seed, F.col(key))), "mix-sized")

    sources = sized.groupBy("_source").agg(F.sum("size").alias("_size"))
    sources = sources.withColumns({"_all": F.lit(0), "_last": F.col("_source").isNull()})
    sources = numbered(sources, "_all", ["_last", "_source"], "mix-order").drop("_n", "_last")
    sources = sources.withColumnRenamed("_pos", "_at")
    sources = shared_out(sources, weights, share, cap)
    total = sources.agg(F.sum("_size")).first()[0] or 0
    seats = F.lit(int(share * total / block + 0.5)).cast("long")
    sources = apportion(sources.withColumn("_seats", seats), "_all", "_target", "_seats", ["_at"])
    # at least one shard
    shards_of = F.greatest(F.ceil(F.col("_size") / shard), F.lit(1))
    sources = sources.select("_source", "_size", "_target", "_quota", "_at", shards_of.alias("_shards"))
    sources = write_and_read(sources, "mix-quotas")

    named = sources.withColumnRenamed("_source", "_name")
    dealt = sized.join(named, F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_shard", F.col("_hash") % F.col("_shards"))
    dealt = write_and_read(dealt.drop("_name", "_shards", "_source"), "mix-dealt")
    shards = dealt.groupBy("_at", "_shard").agg(F.sum("size").alias("_words"), F.first("_quota").alias("_seats"))
    shards = apportion(shards, "_at", "_words", "_seats", ["_shard"])
    blocks = F.ceil(F.col("_words") / block)
    shards = shards.withColumn("_blocks", blocks).withColumn("_quota", F.least(F.col("_quota"), cap * blocks))
    shards = shards.withColumn("_salt", seeded(seed, F.col("_at"), F.col("_shard"))).drop("_seats")
    shards = write_and_read(shards, "mix-shards")

    so_far = Window.partitionBy("_at", "_shard").orderBy("_hash", *[F.col(c) for c in (key, "size")])
    start = F.sum("size").over(so_far.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = dealt.drop("_quota").withColumn("_start", start).join(shards, ["_at", "_shard"])
    placed = placed.withColumn("_block", F.lit(block).cast("long"))
    taken = F.aggregate(
        _covering(), F.lit(0).cast("long"), lambda total, piece: total + piece["n_words"] * piece["copies"]
    )
    out = placed.select(
        *kept, "size", F.col("_size").alias("source_size"), F.col("_target").alias("target"), taken.alias("taken"),
        "_at", "_shard", "_start", "_words", "_blocks", "_quota", "_salt", "_block",
    )
    return Mix(sources, shards, out)


def pieces(mixed: Mix) -> DataFrame:
    """A row for each document and block that covers it and is taken: first_word, n_words and copies."""
    found = mixed.documents.withColumn("_piece", F.explode(_covering())).where("_piece.copies > 0")
    kept = [c for c in mixed.documents.columns if not c.startswith("_")]
    return found.select(*kept, F.col("_at").alias("source_place"), F.col("_shard").alias("shard"), "_piece.*")


def piece_texts(found: DataFrame, text: str = "text") -> DataFrame:
    """`pieces` of a mix that carried its text, with the words of each piece, joined by spaces."""
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]++"), F.lit(0))
    cut = F.slice(words, (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int"))
    return found.withColumn(text, F.array_join(cut, " "))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mix(docs).documents.select("doc_id", "size", "source_size", "target", "taken")


def _seeded_sql(*parts: str) -> str:
    told = " || '/' || ".join(f"coalesce('=' || CAST({p} AS VARCHAR), '-')" for p in parts)
    return f"CAST('0x' || md5({told})[1:15] AS BIGINT)"


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    {_seeded_sql(f"'{SEED}'", "doc_id")} AS h FROM documents),
grand AS (SELECT sum(size)::DOUBLE AS words, floor({SHARE} * sum(size) / {BLOCK} + 0.5) AS seats FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM sized GROUP BY source),
weighed AS (SELECT *, ([{", ".join(f"{w}.0" for w in WEIGHTS)}])[place % {len(WEIGHTS)} + 1]::DOUBLE AS weight FROM sources),
capped AS (
  SELECT *, coalesce(sum(size) OVER earlier, 0)::DOUBLE AS full_size, (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::DOUBLE AS rest,
    {CAP} * size / weight AS ratio, row_number() OVER (ORDER BY {CAP} * size / weight, place) AS turn FROM weighed
  WINDOW earlier AS (ORDER BY {CAP} * size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT coalesce(arg_min(({SHARE} * words - {CAP} * full_size) / rest, turn) FILTER (WHERE ({SHARE} * words - {CAP} * full_size) / rest <= ratio), 0) AS level
  FROM capped, grand),
targets AS (SELECT source, size, place, least(weight * level, {CAP} * size::DOUBLE) AS target FROM weighed, level),
bids AS (
  SELECT place, target / (2 * k + 1) AS quotient FROM targets, LATERAL (SELECT unnest(range((target / {BLOCK})::BIGINT + 3)) AS k) WHERE target > 0),
quotas AS (
  SELECT place, count(*) AS quota FROM (SELECT place, row_number() OVER (ORDER BY quotient DESC, place) AS rn FROM bids), grand WHERE rn <= seats GROUP BY place),
dealt AS (
  SELECT d.*, t.place, t.size AS source_size, t.target, coalesce(q.quota, 0) AS seats, h % greatest(ceil(t.size / {SHARD}), 1)::BIGINT AS shard
  FROM sized d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source LEFT JOIN quotas q ON q.place = t.place),
shards AS (SELECT place, shard, sum(size)::BIGINT AS words, min(seats) AS seats FROM dealt GROUP BY place, shard),
shard_bids AS (
  SELECT place, shard, seats, words::DOUBLE / (2 * k + 1) AS quotient
  FROM shards, LATERAL (SELECT unnest(range(seats)) AS k) WHERE words > 0),
shard_quotas AS (
  SELECT place, shard, count(*) AS quota FROM (
    SELECT place, shard, seats, row_number() OVER (PARTITION BY place ORDER BY quotient DESC, shard) AS rn FROM shard_bids)
  WHERE rn <= seats GROUP BY place, shard),
cut AS (
  SELECT s.place, s.shard, ceil(s.words / {BLOCK})::BIGINT AS blocks, least(coalesce(q.quota, 0), {CAP} * ceil(s.words / {BLOCK}))::BIGINT AS quota,
    {_seeded_sql(f"'{SEED}'", "s.place", "s.shard")} AS salt
  FROM shards s LEFT JOIN shard_quotas q ON q.place = s.place AND q.shard = s.shard),
placed AS (
  SELECT d.*, c.blocks, c.quota, c.salt, row_number() OVER () AS id,
    sum(d.size) OVER (PARTITION BY d.place, d.shard ORDER BY d.h, d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size AS start
  FROM dealt d JOIN cut c ON c.place = d.place AND c.shard = d.shard),
covered AS (
  SELECT id, sum((quota // blocks + CASE WHEN (b * ([{", ".join(map(str, MULTIPLIERS))}])[salt % {len(MULTIPLIERS)} + 1] + salt % blocks) % blocks < quota % blocks THEN 1 ELSE 0 END)
      * (least((b + 1) * {BLOCK}, start + size) - greatest(b * {BLOCK}, start))) AS taken
  FROM placed, LATERAL (SELECT unnest(range((start // {BLOCK})::BIGINT, ((start + size - 1) // {BLOCK})::BIGINT + 1)) AS b) WHERE size > 0 GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN covered USING (id)
"""
