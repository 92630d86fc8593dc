"""Movie-metadata stand-in: one row per order, list columns as Python-literal text.

Per order (= movie) the lists are built from its line items: genres = parts,
companies = suppliers, countries = the suppliers' nations, languages = their
regions, cast = suppliers with a character name, keywords = part size / type.
Returned items get a character name holding an apostrophe, which the literal
form double-quotes (the repair rule must keep such cells).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import standins as S


def _q(c: Column) -> Column:
    """Python repr of a string: single quotes, or double quotes if it holds one."""
    return F.when(F.instr(c, "'") > 0, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), c, F.lit("'")))


def _dict(*pairs) -> Column:
    parts = []
    for i, (k, v) in enumerate(pairs):
        parts += [F.lit(("" if i == 0 else ", ") + f"'{k}': "), v]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def character(li_flag: Column, li_line: Column) -> Column:
    return F.when(li_flag == "R", F.concat(F.lit("R'"), li_line.cast("string"))).otherwise(
        F.concat(li_flag, li_line.cast("string")))


def imdb_id(orderkey: Column, priority: Column, status: Column) -> Column:
    return F.when((priority == "5-LOW") & (status == "P"), F.lit("0")).otherwise(
        F.concat(F.lit("tt"), F.lpad(orderkey.cast("string"), 7, "0")))


def _items(spark, d) -> DataFrame:
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    p = S.table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")
    s = S.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # the narrower side table first: where part is too large to broadcast, its names move once less
    return li.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)


def _places(spark, d) -> DataFrame:
    n = S.table(spark, d, "nation")   # 25 rows by definition
    r = S.table(spark, d, "region")   # 5 rows by definition
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_regionkey", "r_name")


# List column -> the line item columns that its elements are built from.
LISTS = {
    "genres": ("p_partkey", "p_name"),
    "production_companies": ("s_name", "s_suppkey"),
    "production_countries": ("n_nationkey", "n_name"),
    "spoken_languages": ("r_regionkey", "r_name"),
    "cast": ("l_linenumber", "l_returnflag", "s_suppkey", "s_name"),
    "keywords": ("p_size", "p_type"),
}


def _element(name: str, x: Column) -> Column:
    """Literal text of one list element, from its line item ``x``."""
    def text(c: str) -> Column:
        return x[c].cast("string")

    null = F.lit("None")
    if name == "genres":
        return _dict(("id", text("p_partkey")), ("name", _q(x["p_name"])))
    if name == "production_companies":
        return _dict(("name", _q(x["s_name"])), ("id", text("s_suppkey")))
    if name == "production_countries":
        return _dict(("iso_3166_1", _q(F.concat(F.lit("N"), text("n_nationkey")))), ("name", _q(x["n_name"])))
    if name == "spoken_languages":
        return _dict(("iso_639_1", _q(F.concat(F.lit("r"), text("r_regionkey")))), ("name", _q(x["r_name"])))
    if name == "cast":
        return _dict(("cast_id", text("l_linenumber")),
                     ("character", _q(character(x["l_returnflag"], x["l_linenumber"]))),
                     ("credit_id", _q(F.concat_ws("_", F.lit("c"), F.col("_o.o_orderkey").cast("string"), text("l_linenumber")))),
                     ("gender", null), ("id", text("s_suppkey")), ("name", _q(x["s_name"])),
                     ("order", text("l_linenumber")), ("profile_path", null))
    return _dict(("id", text("p_size")), ("name", _q(x["p_type"])))


def _as_list(name: str) -> Column:
    """'[e1, e2, ...]': the order's element texts, sorted (a deterministic order
    whatever the arrival order after the shuffle); NULL for an order without items."""
    elements = F.array_sort(F.transform("_items", lambda x: _element(name, x)))
    return F.when(F.size("_items") > 0, F.concat(F.lit("["), F.array_join(elements, ", "), F.lit("]"))).alias(name)


def item_values(spark, d, lists=tuple(LISTS)) -> DataFrame:
    """(_k, _i): the line items by order key, with the values that move to their order as
    far as ``lists`` need them.  A supplier's nation and region are looked up there."""
    places = _places(spark, d).columns
    moved = [c for c in _needed(lists) if c not in places]
    return (_items(spark, d).where(F.col("l_orderkey").isNotNull())
            .select(F.col("l_orderkey").alias("_k"), F.struct(*moved, "s_nationkey").alias("_i")))


def _needed(lists) -> list[str]:
    return list(dict.fromkeys(c for name in lists for c in LISTS[name]))


def order_items(spark, d, lists=tuple(LISTS), items: DataFrame | None = None,
                part: tuple[int, int] = (0, 1)) -> DataFrame:
    """(_o, _items): every order with its line items, as far as ``lists`` need them.

    Orders and items meet in one exchange by order key and are grouped there as narrow
    values: the texts, several times as wide, are built after it row by row, so that no
    exchange, join or sort has them.  An item whose supplier has no nation or region is no
    item.  Orders without a key have no items and stay out of the exchange.

    ``items`` are the ``item_values`` of the lists, where they are at hand.  ``part``
    (i, n) takes the orders of part i of n, by the hash of their key; those without a key
    are in part 0."""
    i, n = part
    places = _places(spark, d)
    o = S.table(spark, d, "orders")
    order = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    items = item_values(spark, d, lists) if items is None else items
    both = items.unionByName(o.where(F.col("o_orderkey").isNotNull()).select(F.col("o_orderkey").alias("_k"), order.alias("_o")),
                             allowMissingColumns=True)
    if n > 1:   # another hash than that of the exchange, whose partitions else were hit by one part each
        both = both.where(F.pmod(F.xxhash64("_k"), F.lit(n)) == i)
    item = F.struct(*[F.col(c) if c in places.columns else F.col(f"_i.{c}") for c in _needed(lists)])
    met = (both.repartition("_k").join(F.broadcast(places), F.col("_i.s_nationkey") == F.col("n_nationkey"), "left")
           .where(F.col("_i").isNull() | F.col("n_nationkey").isNotNull())
           .select("_k", "_o", F.when(F.col("_i").isNotNull(), item).alias("_i")).groupBy("_k")
           .agg(F.collect_list("_o").alias("_os"), F.collect_list("_i").alias("_items"))
           .select(F.explode("_os").alias("_o"), "_items"))
    if i:
        return met
    none = F.array().cast(met.schema["_items"].dataType)
    return met.unionByName(o.where(F.col("o_orderkey").isNull()).select(order.alias("_o"), none.alias("_items")))


def metadata_columns(rows: DataFrame, lists=tuple(LISTS)) -> DataFrame:
    """movies_metadata-shaped rows of ``order_items``; ``lists`` as given there."""
    o = {c: F.col(f"_o.{c}") for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")}
    k, total = o["o_orderkey"], o["o_totalprice"]
    out = [F.lit(False).alias("adult"), F.lit(None).cast("string").alias("belongs_to_collection"),
           F.floor(total).cast("int").alias("budget"),
           "genres", F.concat(F.lit("site/"), k.cast("string")).alias("homepage"),
           k.cast("int").alias("id"),
           imdb_id(k, o["o_orderpriority"], o["o_orderstatus"]).alias("imdb_id"),
           F.lit("en").alias("original_language"),
           F.concat(F.lit("Order "), k.cast("string")).alias("original_title"),
           F.concat(o["o_orderpriority"], F.lit('\n"'), o["o_orderstatus"],
                    F.lit('", said '), o["o_custkey"].cast("string")).alias("overview"),
           (total / 1000).alias("popularity"),
           F.concat(F.lit("/"), k.cast("string"), F.lit(".jpg")).alias("poster_path"),
           "production_companies", "production_countries",
           F.to_date(o["o_orderdate"]).alias("release_date"),
           F.floor(total * 10000).cast("bigint").alias("revenue"),
           (F.lit(90.0) + total % 60).alias("runtime"),
           "spoken_languages",
           o["o_orderstatus"].alias("status"), F.lit(None).cast("string").alias("tagline"),
           F.concat(F.lit("Movie "), k.cast("string")).alias("title"),
           F.lit(False).alias("video"), F.lit(0.0).alias("vote_average"),
           F.lit(0).alias("vote_count"), "cast", "keywords"]
    columns = [_as_list(c) if isinstance(c, str) else c for c in out if not isinstance(c, str) or c in lists]
    return rows.select(*columns)


def metadata_text(spark, d, lists=tuple(LISTS)) -> DataFrame:
    """movies_metadata-shaped rows (one per order) with literal-list text columns, of
    which only ``lists`` are built."""
    return metadata_columns(order_items(spark, d, lists), lists)


def movies_whole(spark, d, lists=tuple(LISTS)) -> DataFrame:
    """Metadata with the deny list applied and the id prefix cut."""
    from ..functions.fixed import DENY_IMDB_IDS
    from ..operators.clean import deny_and_strip
    return deny_and_strip(metadata_text(spark, d, lists), "imdb_id", DENY_IMDB_IDS)


def credits_text(spark, d) -> DataFrame:
    return metadata_text(spark, d, ("cast",)).select("cast", F.lit(None).cast("string").alias("crew"), "id")


def keywords_text(spark, d) -> DataFrame:
    return metadata_text(spark, d, ("keywords",)).select("id", "keywords")


def file_sources(spark, d, folders: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(movies, credits, keywords, ratings) of the star schema, the first three read
    from their files, whose ``folders`` are given by source name."""
    from .landing import movie_files
    return (*movie_files(spark, d, folders), ratings_raw(spark, d))


def ratings_raw(spark, d) -> DataFrame:
    """ratings file shape: userId, movieId, rating (0.1-5.0), timestamp (epoch s)."""
    li = S.table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").cast("int").alias("userId"),
                     F.col("l_partkey").cast("int").alias("movieId"),
                     (F.col("l_quantity") / 10).alias("rating"),
                     F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("int").alias("timestamp"))
