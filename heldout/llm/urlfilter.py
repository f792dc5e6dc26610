"""URL filters by dated lists.

List entries are dated changes: a key is added to a list, and perhaps removed
and added again.  They become validity intervals [valid_from, valid_to), and
each capture is judged by the entries that were valid when it was fetched.

Keys of a URL, most specific last: its domains (the host and its parents down
to two labels; an IP address has no parents), its directories (host and path up
to a slash), and the URL itself (without scheme, default port and fragment).

The as-of join has an index: the intervals of a key on a list, in order of time, are
cut into chunks of at most ``CHUNK``, and a directory row a key and list has the
days on which its chunks start.  A capture meets the directory by key, which
names the one chunk that can be valid on its day, and then that chunk.  Both
joins have at most one row a key, list and capture, however long an entry
is open and however many entries a key has had.  Only keys and dates are
shuffled; AQE splits a hot key's captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heldout.session import materialize

_URL = r"^(?i:[a-z][a-z0-9+.-]*):(?://)?(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]*)(?::([0-9]*))?([^?#]*)(\?[^#]*)?"
#: Hosts that are addresses: four numbers, or in brackets.
_ADDRESS = r"^(\[.*|[0-9]+(\.[0-9]+){3})$"
#: Intervals that a row of the index holds.
CHUNK = 32


def url_keys(url: Column) -> Column:
    """Array of (kind, key, rank) of a URL; empty where there is no host.
    A higher rank is more specific."""
    part = lambda i: F.regexp_extract(F.trim(url), _URL, i)
    host = F.rtrim(F.lower(part(1)), F.lit("."))
    port = F.when(part(2).isin("", "80", "443"), F.lit("")).otherwise(F.concat(F.lit(":"), part(2)))
    path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    labels, steps = F.split(host, r"\."), F.split(path, "/")
    key = lambda kind, x, rank: F.struct(F.lit(kind).alias("kind"), x.alias("key"), rank.cast("int").alias("rank"))
    count = F.when(host.rlike(_ADDRESS), F.lit(1)).otherwise(F.size(labels))
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), count - 1)), lambda i: key(
        "domain", F.when(i == 1, host).otherwise(F.array_join(F.slice(labels, i, F.size(labels)), ".")), count - i))
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(steps) - 1)), lambda i: key(
        "folder", F.concat(host, port, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/")), 1000 + i))
    whole = F.array(key("url", F.concat(host, port, path, part(4)), F.lit(1_000_000)))
    return F.when(F.coalesce(host, F.lit("")) != "", F.concat(domains, folders, whole)).otherwise(
        F.array().cast("array<struct<kind:string,key:string,rank:int>>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Rows (list, kind, key, valid_from, valid_to) from dated entries (list,
    kind, key, action 'add' or 'remove', day).

    A key is valid from an addition to the next entry; a null ``valid_to`` is
    open.  On one day a removal outweighs an addition.  Entries with a null
    in any column, or another action, count for nothing.
    """
    days = (entries.where("list is not null and kind is not null and key is not null and day is not null "
                          "and action in ('add', 'remove')")
            .groupBy("list", "kind", "key", "day").agg(F.max("action").alias("action")))
    after = Window.partitionBy("list", "kind", "key").orderBy("day")
    return (days.withColumn("valid_to", F.lead("day").over(after)).where("action = 'add'")
            .select("list", "kind", "key", F.col("day").alias("valid_from"), "valid_to"))


def interval_index(valid: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Directory (list, kind, key, starts: the first day of each chunk, in order)
    and chunks (list, kind, key, chunk, intervals) of validity intervals."""
    own = ("list", "kind", "key")
    nth = F.row_number().over(Window.partitionBy(*own).orderBy("valid_from")) - 1
    chunks = materialize(valid.withColumn("chunk", F.floor(nth / F.lit(chunk)).cast("int")).groupBy(*own, "chunk").agg(
        F.min("valid_from").alias("start"), F.collect_list(F.struct("valid_from", "valid_to")).alias("intervals")))
    directory = chunks.groupBy(*own).agg(F.array_sort(F.collect_list("start")).alias("starts"))
    return directory, chunks.drop("start")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows (page_id, fetched, n_block, n_allow, blocked, by_key), one for
    each row of ``captures`` (page_id, url, fetched date).

    ``n_`` columns count the keys of the URL on a block or allow list (lists
    whose names begin so) that were valid on that day; a key on several lists
    of a kind counts once for each.  A capture is blocked if its most specific
    valid block key is more specific than its most specific valid allow key;
    ``by_key`` is the most specific valid key of all (the greater text first
    among equals), or null.  URLs that are null or have no host, and captures
    without a date, match nothing and are not blocked.  Rows with one page_id
    are judged each by itself.
    """
    rows = materialize(captures.select("page_id", "url", "fetched").withColumn("row", F.monotonically_increasing_id()))
    asked = rows.where("fetched is not null").select("row", "fetched", F.inline(url_keys(F.col("url"))))
    directory, chunks = interval_index(validity_intervals(entries))
    started = F.size(F.filter("starts", lambda day: day <= F.col("fetched")))
    valid_then = F.exists("intervals", lambda x: (x["valid_from"] <= F.col("fetched")) & (
        x["valid_to"].isNull() | (F.col("fetched") < x["valid_to"])))
    met = (asked.join(directory, ["kind", "key"]).withColumn("chunk", started - 1).drop("starts")
           .join(chunks, ["list", "kind", "key", "chunk"]).where(valid_then))
    block, allow = F.col("list").startswith("block"), F.col("list").startswith("allow")
    judged = met.where(block | allow).groupBy("row").agg(
        F.count(F.when(block, 1)).alias("n_block"), F.count(F.when(allow, 1)).alias("n_allow"),
        F.max(F.when(block, F.col("rank"))).alias("block_rank"), F.max(F.when(allow, F.col("rank"))).alias("allow_rank"),
        F.max(F.struct("rank", "key")).alias("by"))
    return (rows.join(judged, "row", "left").select(
        "page_id", "fetched", F.coalesce("n_block", F.lit(0)).cast("long").alias("n_block"),
        F.coalesce("n_allow", F.lit(0)).cast("long").alias("n_allow"),
        F.coalesce(F.col("block_rank") > F.coalesce("allow_rank", F.lit(-1)), F.lit(False)).alias("blocked"),
        F.col("by.key").alias("by_key")))
