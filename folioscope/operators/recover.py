"""Second pass: positions confirmed in a company's other files, and the pages that an external classifier looks at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import EngineConfig
from .locate import FILE, met


def consensus(sections: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Of companies with enough confirmed sections (company, start): least, largest and median page, count, all pages."""
    out = sections.groupBy("company").agg(F.min("start").alias("min_page"), F.max("start").alias("max_page"), F.floor(F.median("start")).cast("int").alias("median_page"), F.count("*").alias("n_years"), F.sort_array(F.collect_list("start")).alias("pages"))
    return out.where(F.col("n_years") >= config.min_years)


def search_window(low: Column, high: Column, n: Column, config: EngineConfig = EngineConfig()) -> tuple[Column, Column]:
    span = F.greatest(F.lit(config.window_min_pages), high - low + 1)
    buffer = F.greatest(F.floor(span * F.lit(config.window_buffer)).cast("int"), F.lit(config.window_min_buffer))
    start, end = F.greatest(F.lit(1), low - buffer), F.least(n, high + buffer)
    return F.when(end < start, 1).otherwise(start), F.when(end < start, n).otherwise(end)


def sample_pages(start: Column, end: Column, centre: Column, config: EngineConfig = EngineConfig()) -> Column:
    """Ascending pages: those near the centre, and of the rest as many, evenly spread, as there is room for."""
    lo, hi = F.greatest(start, centre - config.sample_radius), F.least(end, centre + config.sample_radius)
    none = F.expr("cast(array() as array<int>)")
    near = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)
    rest = F.filter(F.when(start <= end, F.sequence(start, end)).otherwise(none), lambda p: (p < lo) | (p > hi))
    room = F.lit(config.sample_pages) - F.size(near)
    step = F.size(rest).cast("double") / room
    spread = F.transform(F.sequence(F.lit(0), room - 1), lambda i: F.element_at(rest, (F.floor(i * step) + 1).cast("int")))
    return F.array_sort(F.concat(near, F.when(room <= 0, none).when(F.size(rest) <= room, rest).otherwise(spread)))


def first_yes(samples: DataFrame, replies: DataFrame) -> DataFrame:
    """Files of samples (pages) with the first page whose reply is yes."""
    asked = samples.select(*FILE, F.explode("pages").alias("page"))
    return asked.join(met(replies.where("verdict").select(*FILE, "page")), [*FILE, "page"]).groupBy(*FILE).agg(F.min("page").alias("start"))


def yes_range(starts: DataFrame, replies: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """starts with end: pages follow while the reply is yes; anything else, a missing page too, stops."""
    after = starts.join(met(replies.select(*FILE, "page", "verdict")), FILE, "left").where(F.col("page").between(F.col("start") + 1, F.col("start") + config.walk_pages))
    w = Window.partitionBy(*FILE).orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    run = after.withColumn("_yes", F.min(F.coalesce(F.col("verdict"), F.lit(False)).cast("int")).over(w)).withColumn("_n", F.count("*").over(w))
    kept = run.where((F.col("_yes") == 1) & (F.col("page") - F.col("_n") == F.col("start"))).groupBy(*FILE).agg(F.max("page").alias("end"))
    return starts.join(met(kept), FILE, "left").withColumn("end", F.coalesce("end", "start"))
