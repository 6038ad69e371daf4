"""A crawl's frontier in rounds, all entities at once.

In a round each entity that has budget left attempts the best link that it has not attempted yet; what the
page links to joins its frontier with new scores, and the next round picks anew.  So each entity reads its
pages in the order in which one that re-sorts its queue after every page would.  A round is a few
joins on (entity, url); its tables are written, so a lost executor costs the tasks of one round.

Defined results: of links to one url the best score counts, ties go to the least url; urls of no known
page are attempts that fail; a page read twice under two urls counts once; entities without links have no rows;
null urls are no links; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.sources.landing import written

#: Pages that an entity may read, and attempts for each of them.
PAGES, TRIES = 3, 4


def crawled(seeds: DataFrame, pages: DataFrame, links: DataFrame, budget: int = PAGES, tries: int = TRIES) -> DataFrame:
    """entity, url, page, attempt (from 1) and nth (of the pages read; null for a failed attempt) in the order read.

    seeds: entity, url, score.  pages: url, page (what it is read as; null if it cannot be read).
    links: page, url, score, of pages to pages, which may differ by ``entity`` if they have that column.
    """
    best = lambda df: df.where("url is not null").groupBy("entity", "url").agg(F.max("score").alias("score"))
    known = written(pages.groupBy("url").agg(F.min("page").alias("page")), "pages")
    edges = written(links, "links")
    frontier = written(best(seeds.select("entity", "url", "score")), "frontier")
    read = None
    # never broadcast: in each round all of these would go through the driver
    merged = lambda df: df.hint("merge")
    for attempt in range(1, budget * tries + 1):
        choice = frontier
        if read is not None:
            spent = read.groupBy("entity").agg(F.count("nth").alias("done")).where(F.col("done") >= budget)
            choice = frontier.join(merged(read.select("entity", "url")), ["entity", "url"], "anti").join(merged(spent), "entity", "anti")
        picked = choice.groupBy("entity").agg(F.min_by("url", F.struct((-F.col("score")).alias("s"), "url")).alias("url"))
        fetched = picked.join(merged(known), "url", "left").select("entity", "url", "page", F.lit(attempt).alias("attempt"))
        if read is None:
            now = fetched.withColumn("nth", F.when(F.col("page").isNotNull(), 1))
        else:
            done = read.where("nth is not null").groupBy("entity").agg(F.max("nth").alias("done"))
            twice = read.where("nth is not null").select("entity", "page", F.lit(True).alias("again"))
            counted = fetched.join(merged(done), "entity", "left").join(merged(twice), ["entity", "page"], "left")
            fresh = F.col("page").isNotNull() & F.col("again").isNull()
            now = counted.select("entity", "url", "page", "attempt", F.when(fresh, F.coalesce("done", F.lit(0)) + 1).alias("nth"))
        now = written(now, f"round{attempt}")
        if not now.limit(1).count():
            break
        read = written(now if read is None else read.unionByName(now), f"read{attempt}")
        on = ["page", "entity"] if "entity" in edges.columns else ["page"]
        found = now.where("nth is not null").select("entity", "page").join(merged(edges), on).select("entity", "url", "score")
        frontier = written(best(frontier.unionByName(found)), f"frontier{attempt}")
    return now if read is None else read
