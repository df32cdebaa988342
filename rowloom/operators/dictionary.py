"""Word dictionaries: a dense index over distinct words, and random picks from it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from rowloom.functions.draws import MASK, below, below_numbered, label_numbers
from rowloom.functions.values import HASH_ID_LENGTH, constant_array
from rowloom.storage import scratch_path

# Words are ordered by their SHA-256. The leading hex digits cut that order into
# buckets of even size, whatever the words are.
BUCKET_DIGITS = 3
# Largest dictionary that is sent to every task, as bytes of its rows in memory.
BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Read a word list, one word per line."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def words_of(texts: DataFrame, column: str, min_letters: int = 1) -> DataFrame:
    """The distinct lower-case words of a text column.

    The distinct is partial before the shuffle, so a frequent word leaves each task once.
    """
    words = texts.select(F.explode(F.split(F.lower(column), r"\P{L}+")).alias("word"))
    return words.where(F.length("word") >= min_letters).distinct()


def _in_bucket() -> WindowSpec:
    return Window.partitionBy("bucket").orderBy("digest")


def _digests(words: DataFrame) -> DataFrame:
    digests = words.select("word", F.sha2("word", 256).alias("digest"))
    return digests.withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS))


def _offsets(sizes: DataFrame) -> DataFrame:
    """The number of words in the buckets before each one."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))


def index_words(words: DataFrame) -> DataFrame:
    """Number the distinct words 0..n-1 in the order of their SHA-256, with their hash ids.

    A row number over all words would sort them in one task. Here each bucket of the
    order is numbered by itself and shifted by the size of the buckets before it. The
    bucket sizes are at most 16 ** BUCKET_DIGITS rows, so broadcasting them is bounded.
    The join is a left join although every bucket has an offset: an inner join would push
    a null check on the digest below the distinct, where it would hash every token and
    keep the two uses of the distinct from sharing one shuffle. Words are dealt to their
    buckets alone and hashed again there: a digest is several times as wide as a word.
    """
    digests = _digests(words.select("word").where("word IS NOT NULL").distinct())
    offsets = _offsets(digests.groupBy("bucket").agg(F.count("*").alias("size")))
    place = F.row_number().over(_in_bucket())
    dealt = digests.select("bucket", "word").repartition("bucket").withColumn("digest", F.sha2("word", 256))
    return dealt.join(F.broadcast(offsets), "bucket", "left").select(
        (F.col("offset") + place - 1).alias("idx"),
        "word",
        F.right("digest", F.lit(HASH_ID_LENGTH)).alias("hash_id"),
    )


_PLACED = "bucket string, place int, word string, digest string"
_SIZES = "bucket string, size long, letters long"


def _store(placed: DataFrame, path: str) -> None:
    """Write words with their places, then the sizes of their buckets; a folder without sizes can't be opened."""
    spark = placed.sparkSession
    placed.select("bucket", F.col("place").cast("int").alias("place"), "word", "digest").write.parquet(f"{path}/words")
    words = spark.read.schema(_PLACED).parquet(f"{path}/words")
    sizes = words.groupBy("bucket").agg(F.count("*").alias("size"), F.sum(F.octet_length("word")).alias("letters"))
    sizes.coalesce(1).write.parquet(f"{path}/buckets")


def _state() -> Column:
    """The two 32-bit words of a row's draw state as one number."""
    return F.shiftleft("__draw_a", 32).bitwiseOR(F.col("__draw_b"))


class Pick(NamedTuple):
    """A random dictionary entry for each row: the draw it uses and the field it takes."""

    output: str
    label: str
    index: int
    field: str


class Dictionary(NamedTuple):
    """An indexed dictionary stored as a table, with its measured size."""

    entries: DataFrame
    size: int
    in_memory_bytes: int

    @classmethod
    def build(cls, words: DataFrame) -> Dictionary:
        """Index the words, store them in the shared folder and measure them.

        The stored table is what the lookups read, so the texts are scanned once and a
        lost executor does not bring that scan back.
        """
        spark = words.sparkSession
        path = scratch_path(spark, "dictionary")
        index_words(words).write.parquet(path)
        entries = spark.read.parquet(path)
        size, letters = entries.agg(
            F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))
        ).first()
        if size == 0:
            raise ValueError("the dictionary has no words")
        return cls(entries, size, letters + size * (ROW_OVERHEAD_BYTES + HASH_ID_LENGTH))

    def save(self, path: str) -> None:
        """Write the dictionary to a new folder, to be opened by later jobs.

        A word's stored place is the one in its bucket of the order, so it stays when words
        come into other buckets; beside the words lies the size of each bucket.
        """
        placed = _digests(self.entries.select("word")).select(
            "bucket", (F.row_number().over(_in_bucket()) - 1).alias("place"), "word", "digest"
        )
        _store(placed, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Dictionary:
        """A saved dictionary. Only its bucket sizes are read, at most 16 ** BUCKET_DIGITS rows."""
        sizes = spark.read.schema(_SIZES).parquet(f"{path}/buckets")
        size, letters = sizes.agg(
            F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("letters"), F.lit(0))
        ).first()
        if size == 0:
            raise ValueError("the dictionary has no words")
        words = spark.read.schema(_PLACED).parquet(f"{path}/words")
        entries = words.join(F.broadcast(_offsets(sizes)), "bucket").select(
            (F.col("offset") + F.col("place")).cast("long").alias("idx"),
            "word",
            F.right("digest", F.lit(HASH_ID_LENGTH)).alias("hash_id"),
        )
        return cls(entries, size, letters + size * (ROW_OVERHEAD_BYTES + HASH_ID_LENGTH))

    @staticmethod
    def extend(spark: SparkSession, path: str, words: DataFrame, into: str) -> Dictionary:
        """Open what a saved dictionary and further words are together, saved to another folder.

        Words that the dictionary holds change nothing. Only buckets that get new words are
        numbered again. The new folder is complete before it is opened, and the old one stays.
        """
        held = spark.read.schema(_PLACED).parquet(f"{path}/words")
        distinct = _digests(words.select("word").where("word IS NOT NULL").distinct())
        fresh_path = scratch_path(spark, "dictionary-new")
        distinct.join(held.select("bucket", "word"), ["bucket", "word"], "left_anti").write.parquet(fresh_path)
        fresh = spark.read.parquet(fresh_path).select("bucket", "word", "digest")
        touched = F.broadcast(fresh.select("bucket").distinct())  # at most 16 ** BUCKET_DIGITS rows
        again = held.join(touched, "bucket", "left_semi").select("bucket", "word", "digest").unionByName(fresh)
        numbered = again.select("bucket", (F.row_number().over(_in_bucket()) - 1).alias("place"), "word", "digest")
        _store(held.join(touched, "bucket", "left_anti").unionByName(numbered), into)
        return Dictionary.open(spark, into)

    def attach(
        self,
        rows: DataFrame,
        picks: list[Pick],
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> DataFrame:
        """Add one column per pick to rows that carry draw state.

        Both ways return the same rows: a null key finds nulls, repeated rows stay repeated.
        """
        if not picks:
            return rows
        if self.in_memory_bytes <= broadcast_bytes:
            return self._attach_array(rows, picks)
        return self._attach_shuffled(rows, picks)

    def _position(self, pick: Pick) -> Column:
        return below(self.size, pick.label, pick.index)

    def _attach_array(self, rows: DataFrame, picks: list[Pick]) -> DataFrame:
        """Look every pick up in an array of the words.

        The array is a scalar subquery that all picks of a field share. Only a measured
        dictionary below the limit comes here, so its one row is bounded. The array
        travels with the stage's broadcast code, once to an executor, and every running
        task unpacks its own copy: a task's memory grows by at most the limit. An array
        access per pick stays in one generated loop; a chain of broadcast joins, which is
        the other way to write this, measured five times slower for two sentences a row.
        """
        arrays = {
            field: self.entries.agg(
                F.sort_array(F.collect_list(F.struct("idx", field)))[field].alias(field)
            ).scalar()
            for field in sorted({pick.field for pick in picks})
        }
        found = [F.get(arrays[pick.field], self._position(pick).cast("int")).alias(pick.output) for pick in picks]
        return rows.select("*", *found)

    def _attach_shuffled(self, rows: DataFrame, picks: list[Pick]) -> DataFrame:
        """One shuffled join for all picks, for a dictionary of any size.

        Picks depend on a row's draw state alone, so only states travel: each distinct one, as
        one number, is unfolded to one row per pick, and back come its words. The rows with their
        columns are shuffled once, to meet the words of their state; a null key meets none.
        What is shuffled per pick is two numbers on the way out, and a number and a word behind
        its slot on the way back, however wide the rows are. Words are dealt by state before they
        are folded: a partial fold before that shuffle would find next to nothing to join.
        Positions are uniform and states distinct, so no join key is hot, and each task hashes
        its share of the dictionary instead of sorting the picks. The slot number is unfolded
        rather than the positions: a position is then computed in a projection, once, where the
        code generator shares its common parts. ``rows`` are read twice, so their keys must not
        change between two reads; a state that lacks words fails the job.
        """
        numbers = [label_numbers(pick.label, pick.index) for pick in picks]
        slot_bits = len(picks).bit_length()
        if self.size << slot_bits >= 1 << 63:
            raise ValueError(f"{len(picks)} picks of {self.size} words do not fit a number of 64 bits")
        first, second = (
            F.get(constant_array([pair[n] for pair in numbers], "bigint"), F.col("slot")) for n in (0, 1)
        )
        states = rows.select(_state().alias("__state")).distinct()
        slots = F.explode(F.sequence(F.lit(0), F.lit(len(picks) - 1))).alias("slot")
        unfolded = (
            states.selectExpr("__state", "shiftrightunsigned(__state, 32) AS __draw_a", f"__state & {MASK}L AS __draw_b")
            .select("*", slots)
            .select("*", first.alias("first_number"), second.alias("second_number"))
            .withColumn("idx", below_numbered(self.size, "first_number", "second_number"))
            .selectExpr("__state", f"shiftleft(idx, {slot_bits}) | slot AS ticket")
        )
        position = F.shiftright("ticket", slot_bits)
        found = unfolded.join(self.entries.hint("shuffle_hash"), position == F.col("idx"), "left")
        slot = F.col("ticket").bitwiseAND(F.lit((1 << slot_bits) - 1).cast("long")).cast("int")
        hash_slots = [number for number, pick in enumerate(picks) if pick.field == "hash_id"]
        value = F.when(slot.isin(hash_slots), F.col("hash_id")).otherwise(F.col("word"))
        # Slots of one width in front of the words: their order as texts is that of the slots.
        width = len(str(len(picks)))
        labels = constant_array([str(number).zfill(width) for number in range(len(picks))])
        folded = (
            found.select("__state", F.concat(F.get(labels, slot), value).alias("value"))
            .repartition("__state")
            .groupBy("__state")
            .agg(F.sort_array(F.collect_list("value")).alias("__values"))
        )
        met = rows.withColumn("__own", _state()).join(
            folded.hint("merge"), F.col("__own") == F.col("__state"), "left"
        )
        unmet = F.col("__own").isNotNull() & (F.coalesce(F.size("__values"), F.lit(0)) != len(picks))
        message = F.lit("rows changed while their words were looked up, or the dictionary lacks words")
        checked = F.when(unmet, F.raise_error(message).cast("array<string>")).otherwise(F.col("__values"))
        outputs = [
            F.substr(F.get(F.col("__values"), number), F.lit(width + 1)).alias(pick.output)
            for number, pick in enumerate(picks)
        ]
        return met.withColumn("__values", checked).select(*(f"`{name}`" for name in rows.columns), *outputs)
