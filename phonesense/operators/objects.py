"""Uploads split at object level: a bad object costs itself, not its upload.

``sensor_raw`` parses an upload as one VARIANT, all or nothing and at most 128 MB. Here
uploads that parse go that way too; only the others are split, by built-in functions:

1. the text is cut at every comma next to a brace or bracket (a superset of the commas between objects);
2. running sums over an upload's pieces (quotes, then braces and brackets outside strings) tell the
   commas that stand outside strings and at the lowest depth so far: these part the
   objects, and each is parsed by itself;
3. objects in a row that do not parse (one cut short takes in those after it, as its
   braces or quotes never close) are split again, at the depths that are never fallen
   below afterwards, and where an object begins with its probe's name. Whether a piece starts outside a string is now told by its own first
   characters, as quotes before it may be missing. What parses there and names
   its probe is taken up again; the rest is rejected, what is left of one object together.

The running sums are windows over the pieces of one upload, narrow and spilling; texts of
one object only are put together again, so an upload of any size can be read, and
one object may have up to 128 MB. Good uploads never reach a window or a shuffle.

The pieces are written once in the checkpoint folder, and dealt out by upload to as many tasks as their size asks
for (``TASK_BYTES``), so a task's memory stays the same when there are more uploads. Left to itself, Spark joins
partitions by their compressed size, which is a small part of what the sorts of the pieces hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from phonesense.functions.variant import get_double, get_string, parse_payload
from phonesense.schemas import KEY_GUID, KEY_PROBE, KEY_TIMESTAMP
from phonesense.session import remove_at_exit, scratch_path

# A VARIANT value holds at most this many bytes; a larger text can't be parsed as one.
VARIANT_LIMIT = 128 * 1024 * 1024 - 16
# What one task takes: bytes of text, and for each piece PIECE_BYTES, the other columns of its row.
TASK_BYTES, PIECE_BYTES = 32 * 1024 * 1024, 128
# Commas after a closing or before an opening brace or bracket; the comma itself is left out.
BREAK = r"(?<=[}\]]\s{0,16}),|,(?=\s*[{\[])"
OPEN, CLOSE = "{[", "}]"
# No nested object has this key.
PROBE_FIRST = rf'^\s*+\{{\s*+"{KEY_PROBE}"\s*+:'
# How a piece (its escapes removed) begins that does not begin inside a string: with an object's first key or its end, an
# array's first element, a whole text, number or word, or a closing mark. A text's own content can't look like that, as its
# quotes are escaped.
OUTSIDE = (r"""^\s*+(?:\{\s*+(?:"[^"]*+"\s*+(?::|$)|\})|\[\s*+[\[{\]"\dtfn-]|"[^"]*+"\s*+(?:[:,}\]]|$)"""
           r"""|(?:-?\d[\d.eE+-]*+|true|false|null)\s*+(?:[,}\]]|$)|[}\]]|$)""")


def _usable(text: Column) -> Column:
    """Whether the text parses as one array; an oversize text is not tried."""
    return F.when(F.octet_length(text) <= VARIANT_LIMIT, parse_payload(text, "PERMISSIVE").isNotNull()).otherwise(False)


def _depth(segments: Column, parity: int) -> Column:
    """Braces and brackets opened less those closed in every other segment between quotes."""
    outside = F.array_join(F.filter(segments, lambda s, i: i % 2 == parity), "")
    count = lambda marks: F.length(outside) - F.length(F.translate(outside, marks, ""))
    return count(OPEN) - count(CLOSE)


def _pieces(uploads: DataFrame) -> tuple[DataFrame, int]:
    """``user_id, upload, idx, piece, chars, quotes, opens`` (starts outside a string), ``outer, inner`` (depth gained if it starts
    outside a string, or inside), each told by the piece alone and written once, and how many tasks are to take them."""
    spark = uploads.sparkSession
    cut = uploads.select("user_id", "upload", F.posexplode(F.split("payload", BREAK)).alias("idx", "piece"))
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    segments = F.split(plain, '"')
    sized = cut.select("*", F.length("piece").alias("chars"), (F.size(segments) - 1).alias("quotes"),
                       F.regexp_like(plain, F.lit(OUTSIDE)).alias("opens"), _depth(segments, 0).alias("outer"), _depth(segments, 1).alias("inner"),
                       (F.octet_length("piece") + PIECE_BYTES).alias("bytes"))
    path = remove_at_exit(spark, scratch_path(spark, "pieces"))
    sized.write.parquet(path)
    kept = spark.read.schema(sized.schema).parquet(path)
    tasks = (kept.agg(F.sum("bytes")).first()[0] or 0) // TASK_BYTES + 1
    # A column read is taken to have nulls; those a join would filter first, and the pieces be shuffled once more for it.
    return kept.drop("bytes").withColumn("upload", F.coalesce("upload", F.lit(0))), tasks


def _counted(sized: DataFrame) -> DataFrame:
    """``user_id, upload, idx, at`` (first character)``, piece, opens`` with ``quoted`` and ``depth`` before it by running sums,
    and with ``step`` (depth gained) by the piece alone."""
    own = Window.partitionBy("upload").orderBy("idx")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    counted = sized.select("*", F.coalesce(F.sum(F.col("chars") + 1).over(before), F.lit(0)).alias("at"),
                           (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("quoted"))
    step = F.when(F.col("quoted"), F.col("inner")).otherwise(F.col("outer"))
    own_step = F.when(F.col("opens"), F.col("outer")).otherwise(F.col("inner"))
    return counted.select("user_id", "upload", "idx", "at", "piece", "quoted", "opens", own_step.alias("step"),
                          F.coalesce(F.sum(step).over(before), F.lit(0)).alias("depth"))


def _strict(pieces: DataFrame) -> DataFrame:
    """Pieces with ``object``, the number of the object that they are part of."""
    own = Window.partitionBy("upload").orderBy("idx")
    lowest = F.min(F.when(~F.col("quoted"), F.col("depth"))).over(own)
    starts = (F.col("idx") == 0) | (~F.col("quoted") & (F.col("depth") <= lowest))
    return pieces.withColumn("object", F.sum(starts.cast("int")).over(own))


def _loose(pieces: DataFrame) -> DataFrame:
    """The pieces of runs of failing objects with ``part``, the number of the object within them."""
    own = Window.partitionBy("upload", "run")
    order = own.orderBy("idx")
    at = pieces.withColumn("after", F.sum("step").over(order)).withColumn("before", F.col("after") - F.col("step"))
    # Down from the last piece: the frame grows, so each piece is seen once.
    least = F.min("after").over(own.orderBy(F.desc("idx")))
    at = at.withColumn("starts", (F.col("idx") == F.min("idx").over(own)) | (F.col("opens") & ((F.col("before") <= least) | F.col("piece").rlike(PROBE_FIRST))))
    return at.withColumn("part", F.sum(F.col("starts").cast("int")).over(order))


def _sized(pieces: DataFrame, *keys: str) -> DataFrame:
    """Pieces with ``size``, the bytes of their object."""
    return pieces.withColumn("size", F.sum(F.octet_length("piece") + 1).over(Window.partitionBy("upload", *keys)))


def _together(pieces: DataFrame, *keys: str) -> DataFrame:
    """The text of each object (null where it is over the limit) and its pieces (``_sized``)."""
    kept = F.when(F.col("size") <= VARIANT_LIMIT, F.struct("idx", "at", "opens", "step", "piece"))
    whole = pieces.select("user_id", "upload", *keys, "idx", "at", kept.alias("kept"))
    put = whole.groupBy("user_id", "upload", *keys).agg(
        F.min("idx").alias("idx"), F.min("at").alias("at"), F.array_sort(F.collect_list("kept")).alias("kept"))
    text = F.when(F.size("kept") > 0, F.array_join(F.transform("kept", lambda p: p["piece"]), ","))
    return put.withColumn("text", text)


def split_objects(raw: DataFrame) -> DataFrame:
    """The objects of the uploads that do not parse as a whole: ``user_id, upload, at`` (first character, from
    0)``, text, reason`` (null where the object is good, else ``malformed`` or ``oversize``)``, elements`` (VARIANTs of a good one)."""
    text = F.col("payload")
    uploads = raw.select(F.col("user_id").cast("string").alias("user_id"), "payload").where(
        text.isNotNull() & (F.trim(text) != "") & ~_usable(text))
    cut, tasks = _pieces(uploads.withColumn("upload", F.monotonically_increasing_id()))
    pieces = _sized(_strict(_counted(cut.repartition(tasks, "upload"))), "object")
    first = _together(pieces, "object").withColumn("elements", _elements("text"))
    good = first.where("elements is not null").select("user_id", "upload", "at", "text", F.lit(None).cast("string").alias("reason"), "elements")

    # Failing objects again, with those next to them (``run``): their pieces are at hand, but for those over the limit.
    before = Window.partitionBy("upload").orderBy("idx")
    numbered = first.withColumn("run", F.sum(F.col("elements").isNotNull().cast("int")).over(before))
    failing = numbered.where("elements is null")
    columns = ("user_id", "upload", "run", "idx", "at", "opens", "step", "piece")
    again = failing.select("user_id", "upload", "run", F.explode("kept").alias("p")).select("user_id", "upload", "run", "p.*")
    large = pieces.where(F.col("size") > VARIANT_LIMIT).join(failing.where("text is null").select("upload", "object", "run"), ["upload", "object"])
    again = again.select(*columns).unionByName(large.select(*columns)).repartition(tasks, "upload")
    second = _together(_sized(_loose(again), "run", "part"), "run", "part").withColumn("elements", _elements("text"))
    named = F.exists("elements", lambda e: get_string(e, KEY_PROBE).isNotNull())
    second = second.withColumn("good", F.coalesce(named, F.lit(False)))
    # What is left of a broken object goes with it: parts in a row that are no objects, up to the next beginning.
    order = Window.partitionBy("upload", "run").orderBy("idx")
    goes_on = ~F.col("good") & ~F.coalesce(F.lag("good").over(order), F.lit(True)) & ~F.coalesce(F.col("text").rlike(PROBE_FIRST), F.lit(False))
    at = second.withColumn("goes_on", goes_on)
    at = at.withColumn("number", F.sum((~F.col("goes_on")).cast("int")).over(order))
    bad = at.where("not good").groupBy("user_id", "upload", "run", "number").agg(
        F.min("at").alias("at"), F.bool_or(F.col("text").isNull()).alias("oversize"), F.array_sort(F.collect_list(F.struct("idx", "text"))).alias("parts"))
    text = F.when(~F.col("oversize"), F.array_join(F.transform("parts", lambda p: p["text"]), ","))
    none = F.lit(None).cast(second.schema["elements"].dataType)
    bad = bad.select("user_id", "upload", "at", text.alias("text"), F.when(F.col("oversize"), "oversize").otherwise("malformed").alias("reason"),
                     none.alias("elements"))
    found = at.where("good").select("user_id", "upload", "at", "text", F.lit(None).cast("string").alias("reason"), "elements")
    return good.unionByName(found).unionByName(bad)


def _elements(text: str) -> Column:
    return F.try_variant_get(parse_payload(F.col(text), "PERMISSIVE"), "$", "array<variant>")


def _indexed(objects: DataFrame) -> DataFrame:
    """``objects`` with ``before``, the number of elements that stand before it in its upload (a bad object is one)."""
    own = Window.partitionBy("upload").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    elements = F.when(F.col("reason").isNull(), F.size("elements")).otherwise(1)
    return objects.withColumn("before", F.coalesce(F.sum(elements).over(own), F.lit(0)).cast("int"))


def recovered_rows(raw: DataFrame) -> DataFrame:
    """``sensor_raw`` rows of the good objects of uploads that do not parse as a whole."""
    at = _indexed(split_objects(raw)).where("reason is null")
    each = at.select("user_id", "before", F.posexplode("elements").alias("pos", "json"))
    return each.select("user_id", (F.col("before") + F.col("pos") + 1).alias("array_index"), get_string("json", KEY_PROBE).alias("probe"),
                       get_double("json", KEY_TIMESTAMP).alias("timestamp"), get_string("json", KEY_GUID).alias("guid"), "json")


def object_rejects(raw: DataFrame) -> DataFrame:
    """The objects that ``sensor_raw(mode="RECOVER")`` leaves out: ``user_id, array_index`` (its place in the
    upload, from 1)``, position`` (its first character, from 0)``, reason, object`` (its text; null
    where it is oversize)."""
    at = _indexed(split_objects(raw)).where("reason is not null")
    return at.select("user_id", (F.col("before") + 1).alias("array_index"), F.col("at").alias("position"), "reason",
                     F.col("text").alias("object"))
