"""Document fingerprints by consistent weighted sampling.

A text is a set of words weighted by their counts. For each of K samples and
each word, hashes of word and sample give r and c from the gamma distribution
(shape 2) and b from the uniform one. With t = floor(ln w / r + b), the word with
the least ln c - r (t - b + 1) is the sample, together with its t. Two texts have
the same sample with a probability equal to their generalised Jaccard
similarity: the sum of the words' lesser counts over that of the greater ones.

All of it is column expressions. Texts are exploded into words only after they
are dealt by document, so counting words and finding samples need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolag.llm.common import partitions
from aerolag.operators.ranking import global_position
from aerolag.sources.stage import Stages

SAMPLES = 32
# Samples that one row computes; a word's row is repeated SAMPLES / GROUP times.
GROUP = 4
BITS = 25  # of each uniform
SCALE = float(1 << 24)  # of the ranking value, rounded to a whole number
DIGITS = 4  # hex digits of a sample in the fingerprint
NO_ID = -(1 << 63)
LOW = (1 << BITS) - 1
LN2 = 0.6931471805599453


def _word_hash(word: Column) -> Column:
    return F.when(word != "", F.xxhash64(word))


def _draws(word: Column, sample: Column) -> tuple[Column, Column, Column, Column]:
    """(r, ln c, b, mark) of a word's hash for one sample."""
    one, two = F.xxhash64(word, sample), F.xxhash64(sample, word)

    def odd(h: Column, shift: int) -> Column:  # 2 x + 1 for a whole number x of BITS bits
        return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(LOW)) * 2 + 1

    full = 2 * (BITS + 1)

    def gamma(h: Column) -> Column:  # minus the logarithm of two uniforms' product
        return F.lit(full * LN2) - F.ln((odd(h, 0) * odd(h, BITS)).cast("double"))

    top = F.shiftleft(F.shiftrightunsigned(one, 2 * BITS), 14).bitwiseOR(F.shiftrightunsigned(two, 2 * BITS))
    return gamma(one), F.ln(gamma(two)), top.cast("double") / float(1 << 28), one


def sample_value(word: Column, weight: Column, sample: Column) -> Column:
    """Ranking value in the upper 32 bits, what identifies (word, t) in the lower; null for no weight.

    The least one over a text's words is its sample.
    """
    r, ln_c, b, mark = _draws(word, sample)
    return _packed(r, ln_c, b, mark, weight)


def _packed(r: Column, ln_c: Column, b: Column, mark: Column, weight: Column) -> Column:
    t = F.floor(F.ln(weight.cast("double")) / r + b)
    rank = ((ln_c - r * (t.cast("double") - b + 1.0)) * SCALE).cast("long")
    found = F.shiftleft(rank, 32).bitwiseOR(F.shiftright(mark, 7).bitwiseXOR(t).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(weight > 0, found)


def likeness(one: Column, two: Column, samples: int = SAMPLES) -> Column:
    """Share of samples that two fingerprints have in common."""
    def part(text: Column, k: Column) -> Column:
        return F.substring(text, k * DIGITS + 1, F.lit(DIGITS))

    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: part(one, k) == part(two, k))
    return F.size(same) / F.lit(float(samples))


def _samples(words: DataFrame, keys: list[str], sides: list[str], samples: int, extra: list[Column]) -> DataFrame:
    """Fingerprints from rows (keys, word hash h, a weight per side): one per side, named as it."""
    # A hash of null is a number too, so words that are none must lose their weight.
    words = words.withColumns({s: F.when(F.col("h").isNotNull(), F.col(s)) for s in sides})
    spread = words.withColumn("__g", F.explode(F.array(*[F.lit(g) for g in range(samples // GROUP)])))
    drawn = []
    for i in range(GROUP):
        r, ln_c, b, mark = _draws(F.col("h"), F.col("__g") * GROUP + i)
        drawn += [r.alias(f"r{i}"), ln_c.alias(f"c{i}"), b.alias(f"b{i}"), mark.alias(f"m{i}")]
    rows = spread.select("*", *drawn)
    least = [F.min(_packed(F.col(f"r{i}"), F.col(f"c{i}"), F.col(f"b{i}"), F.col(f"m{i}"), F.col(s))).alias(f"{s}{i}")
             for s in sides for i in range(GROUP)]
    parts = rows.groupBy(*keys, "__g").agg(*least, *extra)

    def digits(s: str) -> Column:
        return F.concat(*[F.lpad(F.lower(F.hex(F.coalesce(F.col(f"{s}{i}"), F.lit(-1)).bitwiseAND(
            F.lit((1 << 4 * DIGITS) - 1)))), DIGITS, "0") for i in range(GROUP)])

    return parts.select(*keys, "__g", *[digits(s).alias(s) for s in sides],
                        *[c for c in parts.columns if c.startswith("meta")])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, fingerprint) of every row, for texts that need no edited twin."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", "row", F.explode(F.split("text", r"\s+")).alias("word"))
    words = rows.repartition(partitions(docs.sparkSession), "row").groupBy("id", "row", _word_hash(F.col("word")).alias("h"))
    parts = _samples(words.agg(F.count("*").alias("fp")), ["id", "row"], ["fp"], samples, [])
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__g", "fp"))), lambda x: x["fp"]), "")
    return parts.groupBy("id", "row").agg(joined.alias("fingerprint")).select(F.col("id").alias(id_col), "fingerprint")


def _neighbours(docs: DataFrame, stages: Stages) -> DataFrame:
    """(key, before, need): the key whose next document this is, and how many of its characters that one takes."""
    half = F.floor(F.length("text") / 2).cast("int")
    keys = docs.groupBy("key").agg(F.max(half).alias("need"))
    placed = stages.put(global_position(keys, [F.col("key").desc()], "place"), "places")
    last = placed.count()
    return stages.put(placed.select(
        F.col("key").alias("before"), "need", (F.col("place") % F.lit(last) + 1).alias("place")
    ).join(placed.select("key", "place"), "place").select("key", "before", "need"), "neighbours")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of the text whose end is replaced by the next document's start.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    of every row. The last floor(n / 2) code points give way to as many of the next
    document's first, or all of them; next is by falling id, and after the last
    comes the first. Null text: empty; a text without words has a fingerprint of
    its own, all f. Ids are whole numbers; a null id comes last. Rows that share an
    id have the same next document; where several rows of the next id differ, the one
    whose text has the least hash counts. Repeated rows are kept. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    stages = Stages(spark)
    base = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    neighbours = _neighbours(base, stages)
    dealt = base.repartition(2 * partitions(spark), "key")
    order = Window.partitionBy("key").orderBy(F.xxhash64("text"))
    rows = dealt.withColumn("copy", F.row_number().over(order))
    heads = rows.where("copy = 1").join(neighbours, "key").select(
        F.col("before").alias("key"), F.substring("text", F.lit(1), F.col("need")).alias("head"))
    both = rows.join(heads.repartition(2 * partitions(spark), "key"), "key")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    kept = F.substring("text", F.lit(1), n - half)
    swapped = F.substring("head", F.lit(1), half)
    both = both.select("key", "copy", "text", kept.alias("kept"), swapped.alias("swapped"))
    # Whole words of the part that stays count for both texts.
    shared = F.length(F.regexp_extract("kept", r"(?s)^(.*\s)", 1))
    edited = F.concat("kept", "swapped")
    sha = F.sha2(edited, 256)
    pieces = both.select(
        "key", "copy", F.substring("kept", F.lit(1), shared).alias("common"),
        F.substring("text", shared + 1, F.length("text")).alias("own"),
        F.substring(edited, shared + 1, F.length(edited)).alias("other"), sha.alias("sha"), n.alias("n"))
    # The digest and the length travel as rows of their own, four digits groups as numbers.
    meta = [F.struct(F.lit(10 + i).alias("side"), F.substring("sha", 16 * i + 1, 16).alias("word")) for i in range(4)]
    meta.append(F.struct(F.lit(14).alias("side"), F.col("n").cast("string").alias("word")))
    parts = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("word")) for i, c in
                      ((1, "common"), (2, "own"), (3, "other"))], *meta)
    split = pieces.select("key", "copy", F.explode(parts).alias("p")).select(
        "key", "copy", F.col("p.side").alias("side"), F.explode(F.split("p.word", r"\s+")).alias("word"))
    number = F.expr("shiftleft(cast(conv(substring(word, 1, 8), 16, 10) as long), 32) "
                    "| cast(conv(substring(word, 9, 8), 16, 10) as long)")
    value = F.when(F.col("side") < 10, _word_hash(F.col("word"))).when(F.col("side") < 14, number).otherwise(
        F.expr("try_cast(word as long)"))
    marked = split.select("key", "copy", "side", value.alias("h"))
    words = marked.groupBy("key", "copy", F.greatest(F.col("side"), F.lit(9)).alias("meta"), "h").agg(
        F.sum((F.col("side").isin(1, 2)).cast("int")).alias("one"), F.sum((F.col("side").isin(1, 3)).cast("int")).alias("two"))
    extra = [F.max(F.when(F.col("meta") == 10 + i, F.col("h"))).alias(f"meta{i}") for i in range(5)]
    words = words.withColumns({"one": F.when(F.col("meta") == 9, F.col("one")), "two": F.when(F.col("meta") == 9, F.col("two"))})
    found = _samples(words, ["key", "copy"], ["one", "two"], samples, extra)
    line = F.array_sort(F.collect_list(F.struct("__g", "one", "two")))
    whole = found.groupBy("key", "copy").agg(line.alias("line"), *[F.max(f"meta{i}").alias(f"meta{i}") for i in range(5)])
    prints = whole.select(
        "key", "copy", F.col("meta4").alias("n_chars"),
        F.concat(*[F.lpad(F.lower(F.hex(f"meta{i}")), 16, "0") for i in range(4)]).alias("edited_sha256"),
        F.array_join(F.transform("line", lambda x: x["one"]), "").alias("fingerprint"),
        F.array_join(F.transform("line", lambda x: x["two"]), "").alias("edited_fingerprint"))
    prints = stages.put(prints, "prints")
    after = prints.where("copy = 1").select("key", F.col("fingerprint").alias("next")).join(neighbours, "key").select(
        F.col("before").alias("key"), "next")
    kind = docs.schema[id_col].dataType
    return prints.join(after, "key").select(
        F.when(F.col("key") != NO_ID, F.col("key")).cast(kind).alias(id_col), "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next"), samples).alias("near_next"))
