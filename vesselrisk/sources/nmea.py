"""NMEA 0183 sentences (AIVDM / AIVDO) to positions, in column expressions.

Messages of several sentences are put together across the line table. The parts of a message
share (file, total, sequence id) and follow each other within ``REACH`` lines. A run of
such parts ends where the next one is further away, or has the number of the one before (a part was
lost); within a run each ``total`` parts are a message, in any order. Runs are numbered by
distributed prefix sums, so a file with most of the lines is no single task's work.

Defined results: other talkers and types, lines with fewer than seven fields, counts that are no
numbers, payload characters outside the armour, messages under 168 bits, incomplete messages,
and coordinates outside the globe are left out. A time before the sentence (``2024-01-15T10:30:00Z,!AIVDM,...``) is
the position's; else it is ``received_at`` plus a millisecond a line, so that fixes of one vessel stay apart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import in_bbox
from ..operators.ordered import exclusive_prefix_sums
from ..operators.tracks import with_previous
from ..session import cut_lineage

REACH = 64
BLOCK = 4096
# FIXED VALUES: sentence tags, and (start, bits) of the fields by kind of message.
TAGS = ("AIVDM", "AIVDO")
CLASS_A = {"nav_status": (38, 4), "sog": (50, 10), "lon": (61, 28), "lat": (89, 27), "cog": (116, 12)}
CLASS_B = {"sog": (46, 10), "lon": (57, 28), "lat": (85, 27), "cog": (112, 12)}
MESSAGE_BITS = 168
ARMOUR = "".join(chr(v + (48 if v < 40 else 56)) for v in range(64))  # the characters of 0 to 63
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): lines numbered from 0 within each file, however the files are split."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value",
        F.monotonically_increasing_id().alias("id"))
    raw = cut_lineage(raw)  # numbers stay with their lines
    per_split = raw.groupBy("file", "split").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_split.select("file", "split", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return raw.join(offsets, ["file", "split"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line"), "value")


def sentences(lines: DataFrame) -> DataFrame:
    """(file, line, time, total, part, seq_id, payload, fill) of the lines that are AIS sentences."""
    # Fields come out of a generator, so that a line is parsed once and not again for each condition on a field.
    text = F.explode(F.array(F.trim("value"))).alias("text")
    at = lines.select("file", "line", text).select("file", "line", "text", F.explode(F.array(F.regexp_instr("text", F.lit("[!$]")))).alias("start"))
    prefix = F.when(F.col("start") > 1, F.rtrim(F.expr("substring(text, 1, start - 1)"), F.lit(", ")))
    body = F.regexp_replace(F.regexp_replace(F.when(F.col("start") > 0, F.expr("substring(text, start)")).otherwise(F.col("text")), "^[!$]+", ""), "\\*.*$", "")
    f = F.col("f")
    return (
        at.select("file", "line", prefix.alias("prefix"), F.explode(F.array(F.split(body, ","))).alias("f"))
        .withColumn("time", F.col("prefix").try_cast("timestamp"))
        .where((F.size(f) >= 7) & F.upper(F.get(f, 0)).isin(*TAGS))
        .select(
            "file", "line", "time",
            F.get(f, 1).try_cast("int").alias("total"),
            F.when(F.get(f, 2) == "", F.lit(1)).otherwise(F.get(f, 2).try_cast("int")).alias("part"),
            F.get(f, 3).alias("seq_id"), F.get(f, 5).alias("payload"),
            F.when(F.get(f, 6) == "", F.lit(0)).otherwise(F.get(f, 6).try_cast("int")).alias("fill"))
        .where("total >= 1 and part is not null and fill between 0 and 5")
    )


def assemble(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """One row a complete message: (file, line, time, payload, fill); line and time are those of its first sentence."""
    parts = cut_lineage(parts)  # whole messages and parts go apart from here
    single = parts.where("total = 1").select("file", "line", "time", "payload", "fill")
    several = parts.where("total > 1").withColumn("key", F.concat_ws("\n", "file", F.col("total").cast("string"), "seq_id"))
    # The line number stands in for a time here: its previous row in blocks of lines, without one task a key.
    several = several.withColumn("at", F.timestamp_micros("line"))
    near = with_previous(several, ("line", "part"), key="key", ts="at", bucket_us=BLOCK)
    fresh = F.col("prev_line").isNull() | (F.col("line") - F.col("prev_line") > reach) | (F.col("part") == F.col("prev_part"))
    marked = near.select("file", "line", "time", "total", "part", "payload", "fill", "key", fresh.cast("int").alias("fresh"), F.lit(1).alias("one"))
    summed = exclusive_prefix_sums(marked, "key", "line", ["fresh", "one"])
    run = (F.col("cum_fresh") + F.col("fresh")).cast("long")
    placed = cut_lineage(summed.withColumn("run", run))
    first = placed.groupBy("key", "run").agg(F.min("cum_one").alias("first"))
    message = F.floor((F.col("cum_one") - F.col("first")) / F.col("total")).cast("long")
    whole = (
        placed.join(first, ["key", "run"]).withColumn("message", message)
        .groupBy("key", "run", "message")  # at most ``total`` rows
        .agg(F.first("file").alias("file"), F.min("line").alias("line"), F.min_by("time", "line").alias("time"), F.max("total").alias("total"),
             F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("part", "payload", "fill"))).alias("parts"))
        .where("n = total")
    )
    in_turn = F.transform("parts", lambda p: p["part"]) == F.sequence(F.lit(1), F.col("total"))
    return single.unionByName(whole.where(in_turn).select(
        "file", "line", "time", F.array_join(F.transform("parts", lambda p: p["payload"]), "").alias("payload"),
        F.element_at("parts", -1)["fill"].alias("fill")))


def unarmoured(payload: Column) -> Column:
    """The message's first bits in hexadecimal digits, four a digit: the payload is base 64 in other characters."""
    head = F.substring(payload, 1, MESSAGE_BITS // 6)
    return F.hex(F.try_to_binary(F.translate(head, ARMOUR, BASE64), F.lit("base64")))


def unsigned(bits: Column, start: int, n: int) -> Column:
    first, last = start // 4, (start + n - 1) // 4
    digits = F.conv(F.substring(bits, first + 1, last - first + 1), 16, 10).cast("long")
    return F.shiftright(digits, 4 * (last + 1) - start - n).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def signed(bits: Column, start: int, n: int) -> Column:
    v = unsigned(bits, start, n)
    return v - F.when(v >= 1 << (n - 1), F.lit(1 << n)).otherwise(F.lit(0))


def decode(messages: DataFrame, bbox: tuple[float, float, float, float] | None = None, received_at: dt.datetime | None = None) -> DataFrame:
    """Position reports of class A (types 1, 2, 3) and B (18) as positions; ``bbox`` is (lat_min, lon_min, lat_max, lon_max)."""
    b = F.col("bits")
    kind = (
        messages.where(F.col("payload").rlike("^[0-W`-w]+$") & (F.length("payload") * 6 - F.col("fill") >= MESSAGE_BITS))
        .where(F.substring("payload", 1, 1).isin(*[ARMOUR[t] for t in (1, 2, 3, 18)]))  # the first six bits are the type
        .withColumn("bits", F.explode(F.array(unarmoured(F.col("payload")))))  # once a message, whatever is asked of a field
    )
    is_b = F.substring("payload", 1, 1) == ARMOUR[18]

    def field(name: str, of=unsigned) -> Column:
        return F.when(is_b, of(b, *CLASS_B[name])).otherwise(of(b, *CLASS_A[name]))

    late = F.lit(received_at).cast("timestamp") + F.make_dt_interval(secs=F.col("line") / 1000) if received_at else F.lit(None).cast("timestamp")
    out = kind.select(
        unsigned(b, 8, 30).cast("string").alias("mmsi"),
        F.coalesce("time", late).alias("timestamp"),
        (field("lat", signed) / 600_000.0).alias("lat"),
        (field("lon", signed) / 600_000.0).alias("lon"),
        (field("sog") / 10.0).cast("float").alias("sog"),
        (field("cog") / 10.0).cast("float").alias("cog"),
        F.when(is_b, F.lit(0)).otherwise(unsigned(b, *CLASS_A["nav_status"])).cast("int").alias("nav_status"),
        F.lit(0).alias("ship_type"),
        "file", "line",
    ).where("lat between -90 and 90 and lon between -180 and 180")
    if bbox is not None:
        lat_min, lon_min, lat_max, lon_max = bbox
        out = out.where(in_bbox(F.col("lat"), F.col("lon"), (lat_min, lat_max, lon_min, lon_max)))
    return out


def read_nmea(spark: SparkSession, path: str, bbox: tuple[float, float, float, float] | None = None, received_at: dt.datetime | None = None, reach: int = REACH) -> DataFrame:
    return decode(assemble(sentences(read_lines(spark, path)), reach), bbox, received_at)


def armoured(bits: Column, n_chars: int) -> Column:
    """The inverse of ``unarmoured`` for bit strings of 6 * ``n_chars``, a multiple of 24; none for null."""
    digits = [F.lpad(F.conv(F.substring(bits, at + 1, min(48, 6 * n_chars - at)), 2, 16), min(48, 6 * n_chars - at) // 4, "0") for at in range(0, 6 * n_chars, 48)]
    return F.coalesce(F.translate(F.base64(F.unhex(F.concat(*digits))), BASE64, ARMOUR), F.lit(""))


def as_bits(value: Column, n: int) -> Column:
    """A whole number as ``n`` bits, two's complement."""
    return F.lpad(F.bin(F.pmod(value.cast("long"), F.lit(1 << n))), n, "0")


def position_payload(mmsi: Column, lat: Column, lon: Column, sog: Column, cog: Column, nav_status: Column, class_b: Column) -> Column:
    """A position report of 28 characters; used to write test feeds from position tables."""
    whole = lambda c, f: F.floor(c * f + 0.5)
    place = F.concat(as_bits(whole(lon, 600_000.0), 28), as_bits(whole(lat, 600_000.0), 27), as_bits(whole(cog, 10.0), 12))
    head = lambda t: F.concat(as_bits(F.lit(t), 6), F.lit("00"), as_bits(mmsi, 30))
    a = F.concat(head(1), as_bits(nav_status, 4), F.lit("0" * 8), as_bits(whole(sog, 10.0), 10), F.lit("0"), place, F.lit("0" * 40))
    b = F.concat(head(18), F.lit("0" * 8), as_bits(whole(sog, 10.0), 10), F.lit("0"), place, F.lit("0" * 44))
    return armoured(F.when(class_b, b).otherwise(a), MESSAGE_BITS // 6)
