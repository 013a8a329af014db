"""From press releases to dated status changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, documents


def relevant(releases: DataFrame, since: Column, inclusive: bool) -> DataFrame:
    """Releases (title, effective_date, ...) of the window with a fitting title. The archive counts the first day in and keeps undated ones."""
    day = F.col("effective_date")
    window = (day.isNull() | (day >= since)) if inclusive else day > since
    return releases.filter(window & clean.relevant_title(F.col("title"))).withColumn("action", clean.action(F.col("title"))).filter("action is not null")


def deltas(releases: DataFrame, count_names: bool = True) -> DataFrame:
    """Changes (ord, entity_name, action, effective_date, pr_title, pr_link, expected_count, note) of releases
    (ord, title, link, action, effective_date, html).

    A release without names yields one change with a null name; one with fewer or more names than its title says carries a note.
    `count_names` false: a feed's titles are not counted.
    """
    want = clean.expected_count(F.col("title")) if count_names else F.lit(None).cast("int")
    r = documents.with_release_names(releases.withColumn("expected_count", want))
    n = F.size("names")
    note = F.when(n == 0, "names not extracted").when(F.col("expected_count") != n, F.format_string("title states %d, %d extracted", "expected_count", n))
    return r.select(F.col("ord").alias("release_ord"), "action", "effective_date", F.col("title").alias("pr_title"), F.col("link").alias("pr_link"), "expected_count", note.alias("note"), F.posexplode_outer("names").alias("pos", "entity_name")).select(
        F.struct("release_ord", "pos").alias("ord"), "entity_name", "action", "effective_date", "pr_title", "pr_link", "expected_count", "note"
    )


def with_feed(archive: DataFrame, feed: DataFrame) -> DataFrame:
    """Archive changes, and those of the feed whose (link, name) the archive lacks. Repeats inside either stay."""
    known = archive.select("pr_link", "entity_name").distinct()
    same = feed.pr_link.eqNullSafe(known.pr_link) & feed.entity_name.eqNullSafe(known.entity_name)
    return archive.unionByName(feed.join(known, same, "left_anti"))


def incomplete(releases: DataFrame, changes: DataFrame) -> DataFrame:
    """Raw releases to keep for diagnosis: fewer or more names extracted than the title says."""
    odd = changes.filter("note is not null").select(F.col("pr_link").alias("link")).distinct()
    return releases.join(odd, "link", "left_semi")
