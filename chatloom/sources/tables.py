"""Readers: session documents from JSON in both layouts, tables by key ranges over JDBC, and keyed vector caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Control characters that break JSON, besides tab, line feed and carriage return.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"

MESSAGE = T.StructType([T.StructField("id", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("created_at", "actor", "text", "index_name", "session"))])
USE_CASE = T.StructType([T.StructField(c, T.StringType()) for c in ("index_name", "session_id", "use_case", "created_at", "primary_usecase", "secondary_usecase")])
FIELD = T.StructType([T.StructField(c, T.StringType()) for c in ("key_field", "val_field", "key", "value", "created_at")])
META = T.StructType([T.StructField(c, T.StringType()) for c in ("session_id", "index_name", "bot_page", "session_user_state")])
LINK = T.StructType([T.StructField(c, T.StringType()) for c in ("created_at", "link")])
#: The report layout's names, then the daily layout's names for the same content.
SESSION = T.StructType(
    [
        *(T.StructField(c, T.ArrayType(MESSAGE)) for c in ("chat", "messages")),
        *(T.StructField(c, T.ArrayType(USE_CASE)) for c in ("use_cases", "usecases")),
        *(T.StructField(c, T.ArrayType(FIELD)) for c in ("user_field", "user_fields", "user_attributes")),
        *(T.StructField(c, T.ArrayType(META)) for c in ("metadata_for_session", "session_meta")),
        T.StructField("each_session_link_interaction", T.ArrayType(LINK)),
    ]
)


def session_documents(spark: SparkSession, path: str) -> DataFrame:
    """session_id, chat, use_cases, user_field, user_attributes, metadata, links of JSON files, one document a file: an object of
    sessions by id, or an array of such objects, in either layout. Control characters are dropped before parsing. Sessions
    without messages are left out; a session that occurs again takes the content of the last file by name."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", CONTROL, "").alias("v"), F.input_file_name().alias("file"))
    # the array layout is tried first; a lone object is read as an array of one
    listed = F.when(F.ltrim("v").startswith("["), F.col("v")).otherwise(F.concat(F.lit("["), F.col("v"), F.lit("]")))
    maps = F.from_json(listed, T.ArrayType(T.MapType(T.StringType(), SESSION)))
    one = raw.select("file", F.explode(maps).alias("m")).select("file", F.explode("m").alias("session_id", "d"))
    field = F.transform(F.coalesce("d.user_field", "d.user_fields"), lambda x: F.struct(F.coalesce(x["key_field"], x["key"]).alias("key"), F.coalesce(x["val_field"], x["value"]).alias("value"), x["created_at"].alias("created_at")))
    out = one.select(
        "file", "session_id", F.coalesce("d.chat", "d.messages").alias("chat"), F.coalesce("d.use_cases", "d.usecases").alias("use_cases"), field.alias("user_field"),
        F.col("d.user_attributes").alias("user_attributes"), F.coalesce("d.metadata_for_session", "d.session_meta").alias("metadata"), F.col("d.each_session_link_interaction").alias("links"),
    )
    out = out.where(F.size("chat") > 0)
    columns = [c for c in out.columns if c not in ("file", "session_id")]
    last = out.groupBy("session_id").agg(F.max_by(F.struct(*columns), F.col("file")).alias("d"))
    return last.select("session_id", *(f"d.{c}" for c in columns))


def jdbc_range(spark: SparkSession, url: str, table: str, column: str, low: str, high: str, partitions: int = 16, **options: str) -> DataFrame:
    """A table over JDBC, read in ranges of column side by side; a filter on it is pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    bounds = {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": str(partitions)}
    for k, v in {**bounds, **options}.items():
        reader = reader.option(k, v)
    return reader.load().where(F.col(column).between(low, high))


def missing_vectors(texts: DataFrame, cache: DataFrame, dimension: int) -> DataFrame:
    """The distinct texts without a valid vector in cache (text, embedding): no row, null, or another dimension."""
    valid = cache.where(F.size("embedding") == dimension).select(F.col("text").alias("known")).distinct()
    wanted = texts.where("text is not null").select("text").distinct()
    return wanted.join(valid, wanted["text"] == valid["known"], "left_anti")


def assembled(chat: DataFrame, fields: DataFrame, links: DataFrame, image: str = "img:", bought: str = "product_added_to_cart") -> DataFrame:
    """session, chat, fields, bought, links: one document a session that has a message, from flat tables. Messages by time and id, without images (text
    that begins with `image`); links by time; lists without elements are null."""
    said = chat.where(~F.coalesce(F.col("text").startswith(image), F.lit(False)))
    grouped = lambda df, order, rest, name: df.groupBy("session").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
    out = grouped(said, ["made", "id"], ["actor", "text"], "chat").join(grouped(fields, ["made"], ["k", "v"], "fields"), "session", "left").join(grouped(links, ["made"], ["link"], "links"), "session", "left")
    cart = F.filter("fields", lambda x: x["k"] == bought)
    return out.select("session", "chat", "fields", F.when(F.size(cart) > 0, cart).alias("bought"), "links")
