"""Hierarchical median models: medians per key set with a fallback chain.

Fit
    Raw rows are combined once into a ``(keys, value) -> count`` histogram;
    ``GROUPING SETS`` over it builds the histogram of every level at once, then ``median.median_from_histogram`` turns it
    into exact medians without sending a hot group to one task. The result is
    a *model table* ``(level, <key columns>, median, n)``; level ``-1`` holds
    the global median. It is written to the shared checkpoint folder, which
    cuts the lineage and gives exact per-level sizes.

Predict
    One left join on the first level's first key (the anchor): the medians of all
    levels that hold it are one row per anchor value, a map per level from
    the level's other keys. A map holds ``PAGE_ENTRIES`` medians at most: the calendar keys of the presets cannot make
    more, and a level that does (by the ranges of its keys, else counted) is cut into pages by a hash of its
    other keys and joined on anchor and page, which also spreads a hot anchor's rows. Levels without the anchor
    depend on the other keys alone; few medians are literal maps. A NULL key never matches, so a row
    skips every level it lacks a key for. The prediction is the first level that
    matched, else the global median, else 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators import joins
from tallyline.operators.median import COUNT, median_from_histogram
from tallyline.session import materialize, scratch_path, scratch_scope
from tallyline.sources import modelstore

GLOBAL_LEVEL = -1
#: Levels without the anchor are literal up to so many medians together (all hours
#: and weekdays make 199); with more they are joined on an anchor of their own.
MAX_LITERAL_ROWS = 2_000
#: Medians of one level and anchor value in one row; a map is searched one by one. Pages hold half as many on average.
PAGE_ENTRIES = 512


def _level_info(n_levels: int, types: dict[str, T.DataType]) -> list[Column]:
    """One-row summary of a model table: rows per level, global median and count, ranges of whole-number keys."""
    lvl = F.col("level")
    spans = [(F.max(k).cast("decimal(20,0)") - F.min(k).cast("decimal(20,0)")).alias(f"span_{k}") for k, dt in types.items() if isinstance(dt, T.IntegralType)]
    out = [F.count_if(lvl == i).alias(f"rows_{i}") for i in [GLOBAL_LEVEL, *range(n_levels)]]
    out += [F.max(F.when(lvl == GLOBAL_LEVEL, F.col("median"))).alias("global_median"), F.max(F.when(lvl == GLOBAL_LEVEL, F.col("n"))).alias("global_n")]
    return out + spans


def _key_types(schema: T.StructType) -> dict[str, T.DataType]:
    """The key columns of a model table."""
    return {f.name: f.dataType for f in schema.fields if f.name not in ("level", "median", "n")}


def _filler(dt: T.DataType) -> Column:
    """Constant for an unused key slot (level is part of the group key)."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dt)


@dataclass
class HierarchicalMedianModel:
    levels: list[list[str]]  # key columns per level as fitted (missing columns dropped)
    key_types: dict[str, T.DataType]
    table: DataFrame  # level, keys..., median, n
    level_rows: dict[int, int]
    global_median: float
    n_train: int
    target: str
    path: str | None = None
    extra: dict = field(default_factory=dict)
    key_values: dict[str, int] = field(default_factory=dict)  # upper bounds of a key's distinct values, where known

    # -- scoring -----------------------------------------------------------
    def _key(self, keys: list[str]) -> Column:
        """The keys' values as one text; NULL if one is."""
        parts = []
        for k in keys:
            text = F.col(k).cast(self.key_types[k]).cast("string")
            if isinstance(self.key_types[k], T.StringType):  # a text may hold any character, so its length goes first
                parts += [F.length(text).cast("string"), F.lit(":")]
            parts += [text, F.lit("\x1f")]
        return F.concat(F.lit(""), *parts)

    def _other(self, anchor: str, level: int) -> list[str]:
        return [k for k in self.levels[level] if k != anchor]

    def _pages(self, anchor: str, levels: list[int]) -> dict[int, int]:
        """Pages of each level that has more than ``PAGE_ENTRIES`` medians under some anchor value."""
        unknown = []
        for i in levels:
            bound = 1
            for k in self._other(anchor, i):
                bound = min(self.level_rows[i], bound * self.key_values.get(k, self.level_rows[i]))
            if bound > PAGE_ENTRIES:
                unknown.append(i)
        name = ("pages", anchor, tuple(unknown))
        if unknown and name not in self.extra:
            per_anchor = self.table.where(F.col("level").isin(unknown)).groupBy("level", anchor).count()
            largest = {r["level"]: r["most"] for r in per_anchor.groupBy("level").agg(F.max("count").alias("most")).collect()}
            self.extra[name] = {i: -(-2 * most // PAGE_ENTRIES) for i, most in largest.items() if most > PAGE_ENTRIES}
        return self.extra.get(name, {})

    def _page(self, anchor: str, level: int, pages: int) -> Column:
        return F.pmod(F.xxhash64(self._key(self._other(anchor, level))), F.lit(pages))

    def _paged(self, anchor: str, level: int, pages: int) -> DataFrame:
        """One row per anchor value and page with the level's map of the page: other keys -> median (written once)."""
        name = ("paged", anchor, level)
        if name not in self.extra:
            rows = self.table.where(F.col("level") == level)
            entry = F.struct(self._key(self._other(anchor, level)).alias("k"), F.col("median").alias("m"))
            page = self._page(anchor, level, pages).alias("_page")
            maps = rows.groupBy(F.col(anchor).alias("_anchor"), page).agg(F.map_from_entries(F.collect_list(entry)).alias(f"_m{level}"))
            self.extra[name] = joins.sized(maps, "median-pages")
        return self.extra[name]

    def _wide(self, anchor: str, levels: list[int]) -> DataFrame:
        """One row per anchor value with a map per level: other keys -> median (written once)."""
        name = (anchor, tuple(levels))
        if name not in self.extra:
            maps = []
            for i in levels:
                entry = F.struct(self._key(self._other(anchor, i)).alias("k"), F.col("median").alias("m"))
                maps.append(F.map_from_entries(F.collect_list(F.when(F.col("level") == i, entry))).alias(f"_m{i}"))
            rows = self.table.where(F.col("level").isin(levels))
            self.extra[name] = joins.sized(rows.groupBy(F.col(anchor).alias("_anchor")).agg(*maps), "median-lookup")
        return self.extra[name]

    def _literal(self, levels: list[int]) -> dict[int, Column]:
        """The levels' medians as literal maps."""
        rows = self.table.where(F.col("level").isin(levels)).select("level", F.coalesce(*[
            F.when(F.col("level") == i, self._key(self.levels[i])) for i in levels
        ]).alias("k"), "median").collect()
        out = {}
        for i in levels:
            pairs = sorted((row["k"], row["median"]) for row in rows if row["level"] == i)
            out[i] = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
        return out

    def predict(self, df: DataFrame, out_col: str = "prediction", level_col: str | None = "level") -> DataFrame:
        """Adds the raw (unrounded) prediction and the level that produced it."""
        out = df
        # a level whose key is missing from the frame never matches
        used = [i for i, keys in enumerate(self.levels) if keys and self.level_rows.get(i, 0) and all(k in df.columns for k in keys)]
        found: dict[int, Column] = {}
        todo = used
        while todo:
            free = sum(self.level_rows[i] for i in todo)
            if free <= MAX_LITERAL_ROWS and len(todo) < len(used):
                maps = self._literal(todo)
                found |= {i: F.try_element_at(maps[i], self._key(self.levels[i])) for i in todo}
                break
            anchor = self.levels[todo[0]][0]
            with_anchor = [i for i in todo if anchor in self.levels[i]]
            pages = self._pages(anchor, with_anchor)
            one_row = [i for i in with_anchor if i not in pages]
            if one_row:
                right = self._wide(anchor, one_row)
                out = out.join(right, on=out[anchor].cast(self.key_types[anchor]) == right["_anchor"], how="left").drop("_anchor")
            for i in with_anchor:
                if i in pages:
                    right = self._paged(anchor, i, pages[i]).withColumnRenamed("_page", "_right_page")
                    out = out.withColumn("_page", self._page(anchor, i, pages[i]))
                    same = (out[anchor].cast(self.key_types[anchor]) == right["_anchor"]) & (out["_page"] == right["_right_page"])
                    out = out.join(right, on=same, how="left").drop("_anchor", "_page", "_right_page")
                out = out.withColumn(f"_m{i}", F.try_element_at(F.col(f"_m{i}"), self._key(self._other(anchor, i))))
                found[i] = F.col(f"_m{i}")
            todo = [i for i in todo if i not in with_anchor]
        out = out.withColumns({f"_v{i}": found[i] for i in used}) if used else out
        out = out.withColumn(out_col, F.coalesce(*[F.col(f"_v{i}") for i in used], F.lit(float(self.global_median))))
        if level_col:
            lvl = F.lit(GLOBAL_LEVEL)
            for i in reversed(used):
                lvl = F.when(F.col(f"_v{i}").isNotNull(), F.lit(i)).otherwise(lvl)
            out = out.withColumn(level_col, lvl)
        return out.drop(*[f"{x}{i}" for i in used for x in ("_m", "_v")])

    # -- persistence -------------------------------------------------------
    def parts(self) -> tuple[dict[str, DataFrame], dict]:
        """Tables and settings to commit (``modelstore.save``), alone or with those of other models."""
        return {"median": self.table}, {}

    def save(self, path: str) -> None:
        modelstore.save(self.table.sparkSession, path, *self.parts())

    @classmethod
    def load(cls, spark: SparkSession, path: str, levels: list[list[str]], target: str, verify: bool = False) -> "HierarchicalMedianModel":
        """The model committed at ``path``, or the plain table that a fit wrote there."""
        if modelstore.is_store(spark, path):
            table = modelstore.load(spark, path, verify)[0]["median"]
        else:
            table = spark.read.parquet(path)
        return cls._from_table(table, levels, target, path)

    @classmethod
    def _from_table(cls, table: DataFrame, levels: list[list[str]], target: str, path: str | None, info: dict | None = None):
        key_types = _key_types(table.schema)
        fitted = [[k for k in lv if k in key_types] for lv in levels]
        if info is None:
            info = table.agg(*_level_info(len(levels), key_types)).collect()[0].asDict()
        counts = {i: int(info[f"rows_{i}"] or 0) for i in [GLOBAL_LEVEL, *range(len(levels))]}
        global_median = float(info["global_median"]) if info["global_median"] is not None else 0.0
        n_train = int(info["global_n"] or 0)
        key_values = {k: int(info[f"span_{k}"] or 0) + 1 for k in key_types if f"span_{k}" in info}
        key_values |= {k: 2 for k, dt in key_types.items() if isinstance(dt, T.BooleanType)}
        return cls(fitted, key_types, table, counts, global_median, n_train, target, path, key_values=key_values)


class HierarchicalMedian:
    """Estimator: medians of ``target`` for each level of key columns; with ``weight``, a
    column of whole numbers, a row stands for so many."""

    def __init__(self, levels: list[list[str]], target: str = "target", weight: str | None = None):
        self.levels = [list(lv) for lv in levels]
        self.target = target
        self.weight = weight

    def fit_table(self, df: DataFrame) -> tuple[DataFrame, list[list[str]]]:
        """Lazy model table ``(level, keys..., median, n)`` and the fitted levels."""
        present = set(df.columns)
        fitted = [[k for k in lv if k in present] for lv in self.levels]
        keys: list[str] = []
        for lv in fitted:
            for k in lv:
                if k not in keys:
                    keys.append(k)
        t = F.col(self.target).cast("double")
        weight = F.lit(1) if self.weight is None else F.col(self.weight)
        valid = df.select(*keys, t.alias(self.target), weight.cast("long").alias("_weight")).where(t.isNotNull() & ~F.isnan(t))
        types = {f.name: f.dataType for f in valid.schema.fields}

        # One grouping set per distinct key set; duplicate levels share rows.
        sets: list[list[str]] = []
        for lv in fitted:
            if lv and lv not in sets:
                sets.append(lv)
        order = keys + [self.target]
        grouping_sets = [[*s, self.target] for s in sets] + [[self.target]]

        def gid(s: list[str]) -> int:
            bits = 0
            for c in order:
                bits = (bits << 1) | (0 if c in s or c == self.target else 1)
            return bits

        # Raw rows are combined once into a base histogram over all keys; the
        # per-level expansion then runs on that (much smaller) table.
        base = valid.groupBy(*order).agg((F.count(F.lit(1)) if self.weight is None else F.sum("_weight")).alias("_base_cnt"))
        hist = base.groupingSets(grouping_sets, *order).agg(
            F.sum("_base_cnt").alias(COUNT), F.grouping_id().alias("_gid")
        )
        set_id = F.lit(GLOBAL_LEVEL)
        keep = F.col("_gid") == gid([])
        for sid, s in enumerate(sets):
            is_set = F.col("_gid") == gid(s)
            set_id = F.when(is_set, F.lit(sid)).otherwise(set_id)
            nonnull = F.lit(True)
            for k in s:
                nonnull = nonnull & F.col(k).isNotNull()
            keep = keep | (is_set & nonnull)
        hist = hist.where(keep).withColumn("_set", set_id)
        # Encode unused key slots with a constant so every group column is non-NULL.
        slots = []
        for k in keys:
            users = [sid for sid, s in enumerate(sets) if k in s]
            used = F.col("_set").isin(users) if users else F.lit(False)
            slots.append(F.when(used, F.col(k)).otherwise(_filler(types[k])).alias(k))
        hist = hist.select("_set", *slots, self.target, COUNT)

        med = median_from_histogram(hist, ["_set", *keys], self.target, COUNT)

        # Key sets back to levels (duplicate levels share a set) and NULL in unused slots.
        level_ids = F.array(F.lit(GLOBAL_LEVEL))
        for sid, s in enumerate(sets):
            ids = [i for i, lv in enumerate(fitted) if lv == s]
            level_ids = F.when(F.col("_set") == sid, F.array(*[F.lit(i) for i in ids])).otherwise(level_ids)
        restored = []
        for k in keys:
            users = [sid for sid, s in enumerate(sets) if k in s]
            used = F.col("_set").isin(users) if users else F.lit(False)
            restored.append(F.when(used, F.col(k)).alias(k))
        table = med.select(F.explode(level_ids).alias("level"), *restored, "median", "n")
        return table, fitted

    def fit(self, df: DataFrame, path: str | None = None) -> HierarchicalMedianModel:
        """Fit and write the model table (shared checkpoint folder unless ``path``)."""
        spark = df.sparkSession
        path = path or scratch_path(spark, "median-model")
        with scratch_scope(spark):  # the rank histogram is removed once the model is written
            table, _ = self.fit_table(df)
            obs = Observation(f"median-model-{path[-8:]}")  # per-level sizes, computed during the write
            table.observe(obs, *_level_info(len(self.levels), _key_types(table.schema))).write.mode("overwrite").parquet(path)
            info = obs.get
        return HierarchicalMedianModel._from_table(spark.read.parquet(path), self.levels, self.target, path, info)


def constant_model(spark: SparkSession, levels: list[list[str]], target: str, value: float) -> HierarchicalMedianModel:
    """Model with only the global row (used when no training row has a target)."""
    table = spark.createDataFrame([(GLOBAL_LEVEL, float(value), 0)], "level int, median double, n bigint")
    return HierarchicalMedianModel([[] for _ in levels], {}, table, {GLOBAL_LEVEL: 1}, float(value), 0, target, None)


def level_usage(predicted: DataFrame, level_col: str = "level") -> DataFrame:
    """Rows and percent of rows answered by each level (``-1`` = global)."""
    total = F.sum("rows").over(Window.partitionBy())  # over the few per-level rows only
    counts = predicted.groupBy(level_col).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(level_col, "rows", F.round(F.col("rows") * 100.0 / total, 6).alias("percent"))


@dataclass
class SimpleStatsModel:
    """One key set with a mean or median per key and a global value."""

    keys: list[str]
    stats: DataFrame  # keys..., stat
    global_stat: float

    def predict(self, df: DataFrame, out_col: str = "prediction") -> DataFrame:
        """Stat of the row's key, else the global value (also when a key column is
        missing or a key is NULL)."""
        if not self.keys or any(k not in df.columns for k in self.keys):
            return df.withColumn(out_col, F.lit(float(self.global_stat)))
        right = self.stats.select(*[F.col(k).alias(f"_s_{k}") for k in self.keys], F.col("stat").alias("_s_stat"))
        cond = None
        for k in self.keys:
            c = df[k] == right[f"_s_{k}"]
            cond = c if cond is None else cond & c
        out = df.join(right, on=cond, how="left")
        out = out.withColumn(out_col, F.coalesce(F.col("_s_stat"), F.lit(float(self.global_stat))))
        return out.drop("_s_stat", *[f"_s_{k}" for k in self.keys])


def fit_simple_stats(df: DataFrame, keys: list[str], target: str, stat: str = "median") -> SimpleStatsModel:
    """Mean or median of ``target`` per key tuple (NULL keys dropped) plus the global value."""
    valid = df.where(F.col(target).isNotNull())
    present = [k for k in keys if k in valid.columns]
    if stat == "median":  # one fit gives the keyed and the global medians
        model = HierarchicalMedian([present], target).fit(valid)
        global_stat = model.global_median
        table = model.table.where(F.col("level") == 0).select(*present, F.col("median").alias("stat")) if present else None
    else:
        t = F.col(target).cast("double")
        sums = materialize(valid.groupBy(*present).agg(F.sum(t).alias("_s"), F.count(t).alias("_n")), "simple-sums")
        g = sums.agg((F.sum("_s") / F.sum("_n")).alias("stat")).first()["stat"] if valid.columns else None
        global_stat = float(g) if g is not None else 0.0
        known = F.lit(True)
        for k in present:
            known = known & F.col(k).isNotNull()
        table = sums.where(known).select(*present, (F.col("_s") / F.col("_n")).alias("stat")) if present else None
    if table is None:
        return SimpleStatsModel([], df.sparkSession.createDataFrame([], "stat double"), global_stat)
    return SimpleStatsModel(keys if present == keys else [], joins.sized(table, "simple-stats"), global_stat)
