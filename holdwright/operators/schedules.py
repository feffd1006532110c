"""Schedules that a file holds twice: where the names start again, and which half is the period's own.

The unit is a file (a fund's schedule of one period): its rows' order is part of the meaning. A file is cut into stretches
of places, so that its rows are many tasks' work; only what is left of a stretch (its cuts, sums) is put in order by file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import forget, materialize

#: Places of a window that looks ahead.
STRETCH = 8192
#: Places that are added up together where no cut is among them.
BUCKET = 1024


def spaced(df: DataFrame, keys: Sequence[str], place: str, gap: int) -> DataFrame:
    """Greedy in order of place: a row stays if it is more than gap behind the last that stayed. Steps are taken from one that stays to the next."""
    at, by = df.columns.index(place), [df.columns.index(k) for k in keys]
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, place)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            stay, places = np.zeros(b.num_rows, bool), b.column(at).to_numpy(zero_copy_only=False)
            codes = [b.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in by]
            new = np.any([c[1:] != c[:-1] for c in codes], axis=0) if codes else np.zeros(b.num_rows - 1, bool)
            starts = [0, *(np.flatnonzero(new) + 1).tolist()]
            for i, end in zip(starts, [*starts[1:], b.num_rows], strict=True):
                k, run = [b.column(c)[i].as_py() for c in by], places[i:end]
                if k != key:
                    key, last = k, None
                j = 0 if last is None else int(run.searchsorted(last + gap, "right"))
                while j < len(run):
                    stay[i + j], last = True, run[j]
                    j = max(j + 1, int(run.searchsorted(last + gap, "right")))
            yield b.filter(pa.array(stay))

    return dealt.mapInArrow(walk, df.schema)


def restarts(rows: DataFrame, keys: Sequence[str], place: str, name: str, least: int = 200, ahead: int = 12, hits: int = 4, gap: int = 50, sizes: DataFrame | None = None) -> DataFrame:
    """(keys, cut): places (from 0) where a file's names begin anew.

    Early names are those of the first tenth (40 rows at least). A cut is a row with an early name, from the first
    third (60 at least) to 100 before the end, of whose ``ahead`` rows from it on ``hits`` have early names. The windows that look
    ahead lie over stretches of ``STRETCH`` places, each with the first rows of the next one too, so no file is one
    task's. Files under ``least`` rows have none; blank names are no names. sizes (keys, __n): the files' rows, if they are known.
    """
    n = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")) if sizes is None else sizes.select(*keys, "__n")).filter(F.col("__n") >= least)
    d = rows.select(*keys, F.col(place).cast("long").alias("__p"), F.trim(name).alias("__name")).filter("__name <> ''").join(n, list(keys))
    early = d.filter(F.col("__p") < F.greatest(F.lit(40), F.floor(F.col("__n") / 10))).select(*keys, "__name").distinct()
    low, end = F.greatest(F.lit(60), F.floor(F.col("__n") / 3)), F.col("__n") - 100
    known = d.filter((F.col("__p") >= low) & (F.col("__p") < end + ahead - 1)).join(early, [*keys, "__name"], "left_semi")
    own = F.floor(F.col("__p") / STRETCH)
    near = known.select(*keys, "__n", "__p", F.explode(F.sequence(F.floor((F.col("__p") - (ahead - 1)) / STRETCH), own)).alias("__b"))
    w = Window.partitionBy(*keys, "__b").orderBy("__p").rangeBetween(0, ahead - 1)
    found = near.withColumn("__hits", F.count(F.lit(1)).over(w)).filter((F.col("__b") == own) & (F.col("__hits") >= hits) & (F.col("__p") < end))
    return spaced(found.select(*keys, F.col("__p").alias("cut")), keys, "cut", gap)


def neighbour_targets(totals: DataFrame, keys: Sequence[str], period: str, total: str, most: float = 1.3) -> DataFrame:
    """Adds target, next (the following period; at the end the one before) and is_last.

    The target is the median of the totals of two periods on each side that are positive and at most ``most`` times the
    median of all positive ones; without such that median itself.
    """
    all_ = totals.filter(F.col(total) > 0).groupBy(*keys).agg(F.median(total).alias("__all"))
    w = Window.partitionBy(*keys).orderBy(period)
    near = F.array(*[F.lag(total, k).over(w) for k in (2, 1)], *[F.lead(total, k).over(w) for k in (1, 2)])
    d = totals.withColumns({"__near": near, "__after": F.lead(period).over(w), "__before": F.lag(period).over(w)}).join(all_, list(keys))
    d = d.withColumn("__near", F.array_sort(F.filter("__near", lambda x: (x > 0) & (x <= most * F.col("__all")))))
    k = F.size("__near")
    mid = (F.try_element_at("__near", F.floor((k + 1) / 2).cast("int")) + F.try_element_at("__near", F.floor(k / 2).cast("int") + 1)) / 2
    d = d.withColumns({"target": F.when(k > 0, mid).otherwise(F.col("__all")), "next": F.coalesce("__after", "__before"), "is_last": F.col("__after").isNull()})
    return d.drop("__near", "__all", "__after", "__before")


def _live(rows: DataFrame, files: DataFrame, file: Sequence[str], place: str, *more: Column) -> DataFrame:
    """(file, __p, more): what is left of the rows of files, from __start to before __end, with places from there."""
    p = F.col(place).cast("long")
    d = rows.join(files, list(file)).filter((F.col("__start").isNull() | (p >= F.col("__start"))) & (F.col("__end").isNull() | (p < F.col("__end"))))
    return d.select(*file, (p - F.coalesce("__start", F.lit(0))).alias("__p"), *more)


def choose_blocks(rows: DataFrame, twice: DataFrame, files: DataFrame, keys: Sequence[str], period: str, place: str, name: str, value: str) -> DataFrame:
    """(keys, period, cut, is_prefix, __total, __n): for files of about twice their target the half to keep, where one fits.

    Both halves have a fifth of the rows, share 35 per cent of all names, and the kept one is within a tenth of the target.
    Of several that with the most names in common with the next period (share, four places), then the nearest to the
    target, then the first cut, its prefix. A name's first and last place tell on which sides of every cut it is,
    so names are aggregated once, whatever the number of cuts, together with the next period's. Rows and names are added up
    between cuts and within buckets of ``BUCKET`` places; windows lie over these sums alone.
    """
    file = [*keys, period]
    size = ["__start", "__end", "__n"]
    cuts = materialize(restarts(_live(rows, twice.select(*file, *size), file, place, F.col(name)), file, "__p", name, sizes=twice), "cuts")
    twice = twice.join(cuts.select(*file).distinct(), file, "left_semi")
    key = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(name), F.lit(""))), r"[^\p{L}\p{N}]+", " ")).alias("__name")
    bare = rows.select(*file, place, name, value)
    r = _live(bare, twice.select(*file, *size), file, place, key, F.coalesce(F.col(value).cast("double"), F.lit(0.0)).cast("decimal(38,6)").alias("__v"))
    beside = twice.select(*keys, F.col(period).alias("__of"), F.col("next").alias(period)).join(files.select(*file, "__start", "__end"), file)
    theirs = _live(bare, beside, file, place, F.col("__of"), key).select(*keys, F.col("__of").alias(period), F.lit(None).cast("long").alias("__p"), "__name", F.lit(1).cast("long").alias("__in"))
    names = r.select(*file, "__p", "__name", F.lit(0).cast("long").alias("__in")).unionByName(theirs)
    names = names.groupBy(*file, "__name").agg(F.min("__p").alias("__f"), F.max("__p").alias("__l"), F.max("__in").alias("__in"))

    # Blank names count as none here: a filter would be moved to the rows, and each of all files' names be cleaned for it.
    there = (F.col("__name") != "").cast("long")
    own, theirs_in = F.col("__f").isNotNull().cast("long") * there, F.col("__in") * there
    counts, zero = ("__a", "__ai", "__z", "__zi", "__theirs"), F.lit(0).cast("long")
    mark = lambda p, **has: F.struct(F.coalesce(p, zero).alias("__p"), *[has.get(x, zero).alias(x) for x in counts])
    marks = F.array(mark(F.col("__f"), __a=own, __ai=own * F.col("__in"), __theirs=theirs_in), mark(F.col("__l"), __z=own, __zi=own * F.col("__in")))
    bucket = F.floor(F.col("__p") / BUCKET).alias("__b")
    bounds = cuts.select(*file, F.col("cut").alias("__p")).groupBy(*file, bucket).agg(F.collect_list("__p").alias("__cuts"))
    behind = F.when(F.col("__cuts").isNull(), 0).otherwise(F.size(F.filter("__cuts", lambda c: c <= F.col("__p")))).alias("__s")
    part = lambda d: d.select("*", bucket).join(bounds, [*file, "__b"], "left").select("*", behind).groupBy(*file, "__b", "__s")
    sums = part(r.select(*file, "__p", "__v")).agg(F.sum("__v").alias("__v"), F.count(F.lit(1)).alias("__rows"), F.min("__p").alias("cut"))
    s = sums.unionByName(part(names.select(*file, F.inline(marks))).agg(*[F.sum(x).alias(x) for x in counts]), allowMissingColumns=True)
    s = s.groupBy(*file, "__b", "__s").agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("__v", "__rows", *counts)], F.min("cut").alias("cut"))
    whole = Window.partitionBy(*file)
    before = whole.orderBy("__b", "__s").rowsBetween(Window.unboundedPreceding, -1)
    upto = {f"{x}_b": F.coalesce(F.sum(x).over(before), F.lit(0)) for x in ("__v", "__rows", "__a", "__ai", "__z", "__zi")}
    full = {f"{x}_t": F.sum(x).over(whole) for x in ("__v", "__rows", "__a", "__ai", "__theirs")}
    s = s.withColumns({**upto, **full}).filter("__s > 0").join(twice.select(*file, "target"), file)
    n, theirs_n = F.col("__a_t"), F.col("__theirs_t")
    pre, suf = F.col("__a_b"), n - F.col("__z_b")
    s = s.filter((F.least("__rows_b", F.col("__rows_t") - F.col("__rows_b")) >= 0.2 * F.col("__rows_t")) & ((pre + suf - n) / F.greatest(n, F.lit(1)) >= 0.35))

    def half(is_prefix: bool, total, rows_n, names_n, shared):
        err = F.abs(total.cast("double") - F.col("target")) / F.col("target")
        union = F.greatest(names_n + theirs_n - shared, F.lit(1))
        overlap = F.bround(F.when(theirs_n > 0, shared / union).otherwise(0.0), 4)
        score = F.struct(overlap.alias("overlap"), (-err).alias("fit"), (-F.col("cut")).alias("first"), F.lit(is_prefix).alias("is_prefix"), total.cast("double").alias("total"), rows_n.alias("n"))
        return F.when(err <= 0.10, score)

    one = half(True, F.col("__v_b"), F.col("__rows_b"), pre, F.col("__ai_b"))
    two = half(False, F.col("__v_t") - F.col("__v_b"), F.col("__rows_t") - F.col("__rows_b"), suf, F.col("__ai_t") - F.col("__zi_b"))
    best = s.groupBy(*file).agg(F.greatest(F.max(one), F.max(two)).alias("b")).filter("b is not null")
    picks = materialize(best.select(*file, (-F.col("b.first")).alias("cut"), F.col("b.is_prefix").alias("is_prefix"), F.col("b.total").alias("__total"), F.col("b.n").alias("__n")), "blocks")
    forget(cuts)
    return picks


def repair_blocks(rows: DataFrame, keys: Sequence[str], period: str, place: str, name: str, value: str, passes: int = 8, most: float = 1e8) -> DataFrame:
    """Rows without the half of a doubled schedule that isn't the period's; places are numbered from 0 again.

    A repaired period changes its neighbours' targets, so it goes on for up to ``passes`` rounds or until nothing changes.
    A round takes totals at its start; the last period of a fund looks at the period before it as that round has left it.
    Rows are written once. What rounds change is where each file begins and ends (a row a file), and only files of about
    twice their target, with those beside them, are read again.
    Periods, keys and places that are null are files or places of no meaning: such rows stay as they are.
    """
    file = [*keys, period]
    whole = F.lit(True)
    for c in (*file, place):
        whole = whole & F.col(c).isNotNull()
    every = materialize(rows, "schedules")
    now, none = every.filter(whole), F.lit(None).cast("long")
    total = F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0)).cast("decimal(38,6)")).cast("double").alias("__total")
    files = materialize(now.groupBy(*file).agg(total, F.count(F.lit(1)).alias("__n")).withColumns({"__start": none, "__end": none}), "files")
    twice = (F.col("target") > 0) & (F.col("__total") <= most) & (F.col("__total") / F.col("target")).between(1.7, 2.3)
    for _ in range(passes):
        aims = materialize(neighbour_targets(files, keys, period, "__total").filter(twice), "targets")
        changed = False
        for last in (False, True):
            some = aims.filter(F.col("is_last") == last)
            if some.isEmpty():
                continue
            picks = choose_blocks(now, some, files, keys, period, place, name, value)
            if not picks.isEmpty():
                changed, old = True, files
                at, pre = F.coalesce("__start", F.lit(0)) + F.col("cut"), F.col("is_prefix")
                moved = {"__start": F.when(~pre, at).otherwise(F.col("__start")), "__end": F.when(pre, at).otherwise(F.col("__end"))}
                sizes = {x: F.coalesce(f"{x}_p", x) for x in ("__total", "__n")}
                picked = picks.withColumnsRenamed({x: f"{x}_p" for x in sizes})
                files = materialize(old.join(picked, file, "left").withColumns({**moved, **sizes}).select(*old.columns), "files")
                forget(old)
            forget(picks)
        forget(aims)
        if not changed:
            break
    kept = files.filter(F.col("__start").isNotNull() | F.col("__end").isNotNull()).select(*file, "__start", "__end")
    stays = (F.col("__start").isNull() | (F.col(place) >= F.col("__start"))) & (F.col("__end").isNull() | (F.col(place) < F.col("__end")))
    moved = F.when(F.col("__start").isNull(), F.col(place)).otherwise(F.col(place) - F.col("__start")).cast(rows.schema[place].dataType)
    return every.join(kept, file, "left").filter(F.coalesce(stays, F.lit(True))).withColumn(place, moved).select(*rows.columns)
