"""Removal of lines that stand on many sites, with DataFrame functions only.

A line (without the white space around it) is known by two 64-bit hashes. Lines that occur fewer times than ``min_sites``
cannot be on that many sites and are left out first, by a count. For the rest, a HyperLogLog sketch of the sites is built
per line hash; sketches merge by aggregation, so a line that makes up a third of all rows arrives as one sketch per task.
Lines whose estimate is within the sketch's error of the threshold get an exact count of distinct sites. Of a line on at
least ``min_sites`` sites the first occurrence (smallest key, then place) stays and all others are removed, so no content
is lost from the corpus.

A line that holds more than one in 1,024 of the repeated rows is cut into pieces of about that size wherever rows meet line
hashes, so no task sees all of it.

Blank lines are never removed. Null texts stay null; a null site is a site of its own. Rows that agree in key and text are one
document: they keep and lose the same lines. A null key sorts first. Texts are cut whole, at line feeds. An empty table gives
an empty table. Other columns pass through under any name; a column named like ``removed`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import copied_to_pieces, dealt_to_pieces, hot_keys
from ..session import new_run_folder
from .linked_groups import stored

LINE = ["_h1", "_h2"]
ROW = ["_key", "_text_hash"]
AROUND = " \t\r\f\v"


def _row_hash(text: str) -> Column:
    return F.xxhash64(F.col(text))


def line_rows(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """One narrow row per line that is not blank: document, place, site, hashes."""
    cut = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("_key"), _row_hash(text).alias("_text_hash"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("_site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("_place", "_line"),
    )
    cut = cut.withColumn("_line", F.btrim("_line", F.lit(AROUND))).where("_line <> ''")
    return cut.select(*ROW, "_place", "_site", F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), "_line").alias("_h2"))


def spread_lines(repeated: DataFrame, hot: DataFrame, min_sites: int, lg_k: int = 10) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` sites and the first occurrence of each.

    ``repeated`` are line rows, dealt to the pieces of ``hot`` lines; estimates within four standard errors of the threshold
    are replaced by exact counts.
    """
    sketched = repeated.groupBy(*LINE).agg(
        F.hll_sketch_agg("_site", lg_k).alias("_sketch"), F.min(F.struct(*ROW, "_place")).alias("_first"))
    error = max(1.0, 4 * 1.04 / 2 ** (lg_k / 2) * min_sites)
    estimated = sketched.select(*LINE, "_first", F.hll_sketch_estimate("_sketch").alias("_sites"))
    far = estimated.where(F.col("_sites") > min_sites + error).select(*LINE, "_first")
    near = estimated.where(F.col("_sites").between(min_sites - error, min_sites + error)).select(*LINE, "_first")
    sites = repeated.join(copied_to_pieces(near, hot, LINE), [*LINE, "_piece"]).groupBy(*LINE, "_first", "_site").agg(F.lit(1).alias("_one"))
    exact = sites.groupBy(*LINE, "_first").agg(F.count("_one").alias("_sites")).where(F.col("_sites") >= min_sites)
    return far.unionByName(exact.select(*LINE, "_first"))


def without_places(text: Column, places: Column) -> Column:
    """The text without the lines at ``places`` (ascending), put together from the runs between them."""
    lines = F.split(text, "\n")
    stops = F.concat(places, F.array(F.size(lines)))

    def run(stop: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(stops, i - 1) + 1)
        return F.slice(lines, start + 1, stop - start)

    return F.array_join(F.flatten(F.transform(stops, run)), "\n")


def remove_spread_lines(docs: DataFrame, min_sites: int = 5, key: str = "doc_id", text: str = "text", site: str = "source",
                        removed: str = "n_removed") -> DataFrame:
    """All documents; ``text`` without repeated occurrences of spread lines, ``removed`` the number of lines taken out."""
    spark = docs.sparkSession
    lines = line_rows(docs, key, text, site)
    folder = new_run_folder(spark, "lines")
    often = lines.groupBy(*LINE).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_sites)
    often = stored(often, folder, "often")
    hot = hot_keys(often, LINE, "_n")
    found = dealt_to_pieces(lines, hot, LINE, [*ROW, "_place"]).join(
        copied_to_pieces(often, hot, LINE), [*LINE, "_piece"], "left_semi")
    repeated = stored(found, folder, "repeated")  # used three times
    spread = copied_to_pieces(spread_lines(repeated, hot, min_sites), hot, LINE)
    again = repeated.join(spread, [*LINE, "_piece"]).where(~F.struct(*ROW, "_place").eqNullSafe(F.col("_first")))
    places = again.groupBy(*ROW).agg(F.sort_array(F.collect_set("_place")).alias("_places"))
    named = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(key).alias("_row_key"), _row_hash(text).alias("_row_hash"))
    same = F.col("_row_key").eqNullSafe(F.col("_key")) & (F.col("_row_hash") == F.col("_text_hash"))
    joined = named.join(places, same, "left")
    whole = F.col("_doc")[text]
    new = {
        text: F.when(F.col("_places").isNull(), whole).otherwise(without_places(whole, F.col("_places"))),
        removed: F.coalesce(F.size("_places"), F.lit(0)).cast("bigint"),
    }
    names = [*docs.columns, *([removed] if removed not in docs.columns else [])]
    return joined.select(*[(new[c] if c in new else F.col("_doc")[c]).alias(c) for c in names])
