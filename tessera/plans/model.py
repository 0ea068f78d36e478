"""The metric layer: model tables, relationships, measures and ``evaluate``.

A measure lives on a home table.  Group-by and filter columns live on other
tables; a filter flows along relationships from the one/``to`` side to the
many/``from`` side (or both ways when the relationship or the measure says so).
``evaluate`` compiles a request into DataFrame operations only:

* a many:1 hop from a dimension to the fact is a left join (unmatched fact
  keys fall in a NULL "blank" group);
* a many:many hop is a *bridge*: the distinct (group, key) pairs are carried to
  the next table, so a row of the home table is counted once per group however
  many bridge rows link it (no fan-out double counting);
* the home table is pre-aggregated by its bridge key before the bridge join
  (map-side partial aggregation), so a hot key costs one row, not its rows;
* filters on other tables become ``left_semi`` joins on key sets;
* several measures are aligned with a null-safe full outer join on the group
  columns.

There is no parser or planner: this is DataFrame composition and Catalyst does
the physical planning (broadcast of small sides under its size threshold, AQE
skew handling for big ones).
"""
from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field, replace
from datetime import timedelta
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    name: str
    from_table: str
    from_col: str
    to_table: str
    to_col: str
    cardinality: str = "many:1"        # "many:1" or "many:many"
    both: bool = False                 # cross-filter in both directions


@dataclass(frozen=True)
class Measure:
    name: str
    table: str
    kind: str                          # sum | count | avg | distinct
    column: str | None = None
    crossfilter_both: tuple = ()       # relationship names switched to both directions
    format: str | None = None


@dataclass
class Edge:
    src: str
    src_col: str
    dst: str
    dst_col: str
    rel: Relationship

    @property
    def lookup(self) -> bool:
        """True if every dst row matches at most one src row (src is the one side)."""
        return self.rel.cardinality == "many:1" and self.src == self.rel.to_table


def _split(ref: str) -> tuple[str, str]:
    t, c = ref.rsplit(".", 1)
    return t, c


@dataclass
class Model:
    tables: dict[str, Callable[[], DataFrame]]
    relationships: list[Relationship]
    measures: dict[str, Measure]
    summarize_by: dict[str, str] = field(default_factory=dict)   # "table.col" -> sum|none
    hierarchies: dict[str, list[str]] = field(default_factory=dict)
    date_columns: dict[str, str] = field(default_factory=dict)      # table -> its date column
    sort_by: dict[str, str] = field(default_factory=dict)           # "table.col" -> column of the same table that orders it

    # -- metadata -----------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return self.tables[name]()

    def edges(self, measure: Measure | None = None) -> list[Edge]:
        out = []
        for r in self.relationships:
            out.append(Edge(r.to_table, r.to_col, r.from_table, r.from_col, r))
            if r.both or (measure is not None and r.name in measure.crossfilter_both):
                out.append(Edge(r.from_table, r.from_col, r.to_table, r.to_col, r))
        return out

    def path(self, src: str, dst: str, measure: Measure | None = None) -> list[Edge]:
        """Shortest filter-flow path from table `src` to table `dst`."""
        if src == dst:
            return []
        edges = self.edges(measure)
        prev: dict[str, Edge] = {}
        seen = {src}
        q = deque([src])
        while q:
            t = q.popleft()
            for e in edges:
                if e.src == t and e.dst not in seen:
                    seen.add(e.dst)
                    prev[e.dst] = e
                    if e.dst == dst:
                        p = [e]
                        while p[0].src != src:
                            p.insert(0, prev[p[0].src])
                        return p
                    q.append(e.dst)
        raise ValueError(f"no filter path from {src} to {dst}")

    # -- compilation ----------------------------------------------------------
    def _filtered(self, name: str, filters: dict) -> DataFrame:
        df = self.table(name)
        for ref, cond in filters.items():
            t, c = _split(ref)
            if t == name:
                df = df.filter(_cond(F.col(c), cond))
        return df

    def _carry(self, start: DataFrame, cols: list[str], path: list[Edge], filters: dict,
               m: Measure | None = None, visiting: frozenset = frozenset()) -> DataFrame:
        """Walk every hop but the last, keeping distinct (cols, key); returns cols + ``_k``.

        Intermediate tables are restricted by every filter that reaches them, so a
        bridge only passes keys of rows that satisfy the whole filter context.
        """
        cur = start.select(*cols, F.col(path[0].src_col).alias("_k")).distinct()
        for i, e in enumerate(path[:-1]):
            nxt = path[i + 1]
            t = self._restricted(e.dst, filters, m, visiting) \
                .select(F.col(e.dst_col).alias("_j"), F.col(nxt.src_col).alias("_n"))
            cur = cur.join(t, cur["_k"] == t["_j"]).select(*cols, F.col("_n").alias("_k")).distinct()
        return cur

    def _restricted(self, name: str, filters: dict, m: Measure | None = None,
                    visiting: frozenset = frozenset(), carried: frozenset = frozenset()) -> DataFrame:
        """Table `name` under the filter context: its own filters plus one ``left_semi`` join
        per incoming relationship that a filtered table reaches it through.  The key set of
        that relationship comes from the neighbour table restricted by every filter reaching
        *it*, so filters combine as one context (rows satisfying all of them), and the fact
        behind a hub is scanned once however many filters pass through it.  `carried`: relationships
        (src, src_col, dst_col) that a bridge brings the restricted keys of anyway."""
        df = self._filtered(name, filters)
        visiting = visiting | {name}
        last_edges: dict = {}
        for t in dict.fromkeys(_split(r)[0] for r in filters):
            if t in visiting:
                continue
            try:
                p = self.path(t, name, m)
            except ValueError:
                continue  # this filter does not reach the table
            if any(e.dst in visiting for e in p[:-1]):
                continue
            e = p[-1]
            last_edges.setdefault((e.src, e.src_col, e.dst_col), e)
        for (src, src_col, dst_col), e in last_edges.items():
            if (src, src_col, dst_col) in carried:
                continue
            keys = self._restricted(src, filters, m, visiting).select(F.col(src_col).alias("_k"))
            df = df.join(keys, df[dst_col] == keys["_k"], "left_semi")
        return self._within_dates(df, name, filters)

    def _within_dates(self, df: DataFrame, name: str, filters: dict) -> DataFrame:
        """Filters on Date, when it is directly related to table `name`, also as a range of the table's
        own date column: the range reaches the scan, where the semi-join on the computed key does
        not.  The Date table is bounded (366 rows a year); its least and greatest kept date are
        one row."""
        own = {r: c for r, c in filters.items() if _split(r)[0] == "date"}
        related = any(r.to_table == "date" and r.from_table == name for r in self.relationships)
        if not own or not related or name not in self.date_columns:
            return df
        lo, hi = self._filtered("date", own).agg(F.min("date"), F.max("date")).first()
        c = F.col(self.date_columns[name])
        if lo is None:
            return df.filter(F.lit(False))
        return df.filter((c >= F.lit(lo)) & (c < F.lit(hi + timedelta(days=1))))

    def _home(self, m: Measure, filters: dict, group_tables: list[str] = ()) -> DataFrame:
        """The measure's table under the filters.  A group table that reaches it through a hub brings (group,
        key) pairs of the hub's kept rows, and only those keys are joined: the hub need not be read
        again to restrict the home table."""
        paths = [p for t in group_tables if t != m.table and (p := self._reach(t, m)) and len(p) > 1]
        carried = frozenset((p[-1].src, p[-1].src_col, p[-1].dst_col) for p in paths)
        return self._restricted(m.table, filters, m, carried=carried)

    def replace_table(self, name: str, fn: Callable[[], DataFrame]) -> "Model":
        """A copy of the model where table `name` is defined by `fn`."""
        tables = dict(self.tables)
        tables[name] = fn
        return replace(self, tables=tables)

    def partials(self, m: Measure, group_by: list[str], filters: dict | None = None,
                 extra_home: dict[str, Column] | None = None) -> DataFrame:
        """Group columns (aliased g0, g1, …) + partial aggregates of `m` (see `finalize`).

        `extra_home` adds named grouping expressions computed on the home table
        (e.g. its date).
        """
        filters = filters or {}
        home = self._home(m, filters)
        extra_home = extra_home or {}
        extra_names = list(extra_home)
        gtabs = {}
        for i, ref in enumerate(group_by):
            t, c = _split(ref)
            gtabs.setdefault(t, []).append((f"g{i}", c))
        val = F.col(m.column) if m.column else F.lit(1)
        home = home.withColumn("_v", val)
        for n, c in extra_home.items():
            home = home.withColumn(n, c)

        direct = [(a, c) for t, lst in gtabs.items() if t == m.table for a, c in lst]
        for a, c in direct:
            home = home.withColumn(a, F.col(c))
        keys_out = [a for a, _ in direct] + extra_names
        bridged = None
        for t, lst in gtabs.items():
            if t == m.table:
                continue
            p = self.path(t, m.table, m)
            dim = self._filtered(t, filters)
            if len(p) == 1 and p[0].lookup:
                d = dim.select(F.col(p[0].src_col).alias("_dk"), *[F.col(c).alias(a) for a, c in lst])
                home = home.join(d, home[p[0].dst_col] == d["_dk"], "left").drop("_dk")
                keys_out += [a for a, _ in lst]
            else:
                if bridged is not None:
                    raise ValueError("only one bridged group table per evaluation")
                start = dim.select(*[F.col(c).alias(a) for a, c in lst], F.col(p[0].src_col))
                bridged = (self._carry(start, [a for a, _ in lst], p, filters, m, frozenset({m.table})),
                           [a for a, _ in lst], p[-1].dst_col)
        if bridged is None:
            return _aggregate(home, keys_out, m.kind)
        bridge, bcols, key = bridged
        pre = _aggregate(home.withColumn("_key", F.col(key)), keys_out + ["_key"], m.kind)
        joined = bridge.join(pre, bridge["_k"] == pre["_key"]).drop("_k", "_key")
        return _reaggregate(joined, keys_out + bcols, m.kind)

    def without(self, *names: str) -> "Model":
        """A copy of the model without some relationships."""
        left = [r for r in self.relationships if r.name not in names]
        return replace(self, relationships=left)

    def period_pairs(self, m: Measure, group_by: list[str], filters: dict, period: Callable[[Column], Column]
                     ) -> tuple[DataFrame, DataFrame]:
        """For a measure that dates reach through a bridge (reviews by the order dates of their
        customers): distinct (g0.., _p, _k), the bridge keys of each group and period; and the
        measure's partials (_p0, _p1) per key.  Group tables must be look-ups of the bridging table."""
        path = self.path("date", m.table, m)
        hub, key = path[-1].src, path[-1].src_col
        rows = self._restricted(hub, filters, m, frozenset({m.table}))
        rows = rows.withColumn("_p", period(F.col(self.date_columns[hub])))
        for i, ref in enumerate(group_by):
            t, c = _split(ref)
            if t == hub:
                rows = rows.withColumn(f"g{i}", F.col(c))
                continue
            p = self.path(t, hub, m)
            if len(p) != 1 or not p[0].lookup:
                raise ValueError(f"{t} is no look-up of {hub}")
            d = self._filtered(t, filters).select(F.col(p[0].src_col).alias("_dk"), F.col(c).alias(f"g{i}"))
            rows = rows.join(d, rows[p[0].dst_col] == d["_dk"], "left").drop("_dk")
        gk = [f"g{i}" for i in range(len(group_by))]
        pairs = rows.select(*gk, "_p", F.col(key).alias("_k")).distinct()
        home = self._restricted(m.table, {r: c for r, c in filters.items() if _split(r)[0] == m.table}, m)
        home = home.withColumn("_v", F.col(m.column) if m.column else F.lit(1))
        per_key = _aggregate(home.withColumn("_hk", F.col(path[-1].dst_col)), ["_hk"], m.kind)
        return pairs, per_key

    def related_to_dates(self, m: Measure) -> bool:
        return "date" in self.tables and self._reach("date", m) is not None

    def _reach(self, t: str, m: Measure) -> list[Edge] | None:
        """Filter-flow path from a group table to the measure's table; None if they are unrelated."""
        try:
            return self.path(t, m.table, m)
        except ValueError:
            return None

    def _evaluate_group(self, ms: list[Measure], group_by: list[str], filters: dict) -> DataFrame:
        """Final values of measures sharing a home table and cross-filter setting, from one pass
        over the home table, by one plan for all sizes.

        The home table is first reduced to one row per (own group columns, join keys, values that are
        counted distinctly) with partial sums and counts; map-side aggregation absorbs hot keys.
        Then the group tables are joined: a look-up by its key, a bridge by its distinct (group,
        key) pairs, so that a row counts once per group.  With look-ups into several tables the
        combinations of keys would hardly be fewer than the rows, so those are joined first.
        A group table unrelated to the measure repeats the result for each of its groups."""
        m0 = ms[0]
        gk = [f"g{i}" for i in range(len(group_by))]
        home = self._home(m0, filters, [_split(g)[0] for g in group_by])
        for i, m in enumerate(ms):
            home = home.withColumn(f"_v{i}", F.col(m.column) if m.column else F.lit(1))
        gtabs: dict = {}
        for i, ref in enumerate(group_by):
            t, c = _split(ref)
            gtabs.setdefault(t, []).append((f"g{i}", c))
        own, lookups, bridges, apart = [], [], [], []
        for t, lst in gtabs.items():
            names = [a for a, _ in lst]
            if t == m0.table:
                for a, c in lst:
                    home = home.withColumn(a, F.col(c))
                own += names
                continue
            p, dim = self._reach(t, m0), self._filtered(t, filters)
            if p is None:
                apart.append(dim.select(*[F.col(c).alias(a) for a, c in lst]).distinct())
            elif len(p) == 1 and p[0].lookup:
                lookups.append((dim.select(F.col(p[0].src_col).alias("_k"), *[F.col(c).alias(a) for a, c in lst]),
                                p[0].dst_col, names, "left"))
            else:
                start = dim.select(*[F.col(c).alias(a) for a, c in lst], F.col(p[0].src_col))
                bridges.append((self._carry(start, names, p, filters, m0, frozenset({m0.table})), p[-1].dst_col, names,
                                "inner"))
        if len(lookups) > 1:
            for d, key, names, _ in lookups:
                home = home.join(d, home[key] == d["_k"], "left").drop("_k")
                own += names
            lookups = []
        joins = lookups + bridges
        values = [f"_v{i}" for i, m in enumerate(ms) if m.kind == "distinct"]
        keys = []
        for j, (_, key, _, _) in enumerate(joins):
            home = home.withColumn(f"_key{j}", F.col(key))
            keys.append(f"_key{j}")
        pre, fin = [], []
        for i, m in enumerate(ms):
            v = F.col(f"_v{i}")
            if m.kind == "distinct":
                fin.append(distinct_count_with_blank(v).alias(m.name))
                continue
            pre.append((F.count(F.lit(1)) if m.kind == "count" else F.sum(v)).alias(f"_s{i}"))
            if m.kind == "avg":
                pre.append(F.count(v).alias(f"_c{i}"))
                fin.append(F.try_divide(F.sum(f"_s{i}"), F.sum(f"_c{i}").cast("double")).alias(m.name))
            else:
                total = F.sum(f"_s{i}")
                # a grand total of nothing: COUNT is 0 there, a sum NULL
                fin.append((F.coalesce(total, F.lit(0)) if m.kind == "count" and not group_by else total).alias(m.name))
        out = home.groupBy(*own, *keys, *values).agg(*pre) if pre else home.select(*own, *keys, *values).distinct()
        for j, (d, _, _, how) in enumerate(joins):
            out = out.join(d, out[f"_key{j}"] == d["_k"], how).drop("_k", f"_key{j}")
        here = own + [n for _, _, names, _ in joins for n in names]
        out = out.groupBy(*here).agg(*fin)
        for d in apart:
            out = out.crossJoin(d)  # the product is the result asked for: every group repeats it
        return out.select(*gk, *[m.name for m in ms])

    def evaluate(self, measures: list[str], group_by: list[str] | None = None, filters: dict | None = None,
                 keep_empty: bool = False) -> DataFrame:
        """One row per group with one column per measure (named after the measure).

        Measures of the same home table (and cross-filter setting) are computed in one pass;
        results of different home tables are aligned with a null-safe full outer join.
        Rows whose measures are all NULL are dropped unless `keep_empty`.
        """
        group_by = group_by or []
        filters = filters or {}
        names = [_split(g)[1] for g in group_by]
        gcols = [f"g{i}" for i in range(len(group_by))]
        groups: dict = {}
        for mname in measures:
            m = self.measures[mname]
            groups.setdefault((m.table, m.crossfilter_both), []).append(m)
        result = None
        for ms in groups.values():
            one = self._evaluate_group(ms, group_by, filters)
            result = one if result is None else align(result, one, gcols)
        if not keep_empty and measures:
            result = result.filter(F.greatest(*[F.col(n).isNotNull() for n in measures]) if len(measures) > 1
                                   else F.col(measures[0]).isNotNull())
        return result.select(*[F.col(g).alias(n, metadata=self.about(ref)) for g, n, ref in zip(gcols, names, group_by)], *measures)

    def about(self, ref: str) -> dict:
        """Column metadata of a group column: where it comes from, and the column that orders it."""
        by = self.sort_by.get(ref)
        return {"group": ref} | ({"sort_by": by} if by else {})

    def order(self, df: DataFrame, position: str | None = None) -> DataFrame:
        """A result of ``evaluate``, ``with_time`` or ``items_long`` in the order of its group columns: each by the
        column that its metadata names (of the result itself, or of the table it comes from: one value
        a group, the least), else by itself.  `position` adds the 1-based place of each row; results
        are as large as their groups, and so is the one window that counts them."""
        out, keys = df, []
        for i, f in enumerate(df.schema.fields):
            ref, by = f.metadata.get("group"), f.metadata.get("sort_by")
            if by and by in df.columns:
                keys.append(F.asc_nulls_first(by))
            elif by:
                t, c = _split(ref)
                known = self.table(t).groupBy(F.col(c).alias(f"_v{i}")).agg(F.min(by).alias(f"_o{i}"))
                out = out.join(known, out[f.name].eqNullSafe(known[f"_v{i}"]), "left")
                keys.append(F.asc_nulls_first(f"_o{i}"))
            if ref:
                keys.append(F.asc_nulls_first(f.name))
        if not keys:
            return df
        if position:
            return out.select(*df.columns, F.row_number().over(Window.orderBy(*keys)).alias(position)).orderBy(position)
        return out.orderBy(*keys).select(*df.columns)

    def drill(self, measures: list[str], table: str, levels: list[str], filters: dict | None = None) -> DataFrame:
        """Measures at every prefix of the hierarchy `levels` of `table`, with ``level`` =
        the roll-up bitmask (bit set = that column rolled up, first column highest bit).

        Measures of one fact reached by a many:1 hop are reduced first — to (levels, partial
        sums / counts) for additive measures and averages, to distinct (levels, value) pairs
        for distinct counts — and then rolled up, which is exact for every kind; bridged
        measures are evaluated per level and unioned.
        """
        filters = filters or {}
        ms = [self.measures[n] for n in measures]
        home = {(m.table, m.crossfilter_both) for m in ms}
        n = len(levels)
        if len(home) == 1:
            m0 = ms[0]
            p = self.path(table, m0.table, m0)
            if len(p) == 1 and p[0].lookup:
                fact = self._home(m0, filters)
                dim = self._filtered(table, filters).select(F.col(p[0].src_col).alias("_dk"), *levels)
                j = fact.join(dim, fact[p[0].dst_col] == dim["_dk"], "left")
                for i, m in enumerate(ms):
                    j = j.withColumn(f"_v{i}", F.col(m.column) if m.column else F.lit(1))
                out = None
                # additive and average measures: reduce to (levels, partial sums) then roll up
                add = [(i, m) for i, m in enumerate(ms) if m.kind != "distinct"]
                if add:
                    pre, fin = [], []
                    for i, m in add:
                        v = F.col(f"_v{i}")
                        if m.kind == "count":
                            pre.append(F.count(F.lit(1)).alias(f"_s{i}"))
                        else:
                            pre.append(F.sum(v).alias(f"_s{i}"))
                        if m.kind == "avg":
                            pre.append(F.count(v).alias(f"_c{i}"))
                            fin.append(F.try_divide(F.sum(f"_s{i}"), F.sum(f"_c{i}").cast("double")).alias(m.name))
                        else:
                            fin.append(F.sum(f"_s{i}").alias(m.name))
                    base = j.groupBy(*levels).agg(*pre)
                    out = base.rollup(*levels).agg(*fin, F.grouping_id().alias("level"))
                # distinct counts: reduce to distinct (levels, value) pairs, then roll up
                for i, m in enumerate(ms):
                    if m.kind != "distinct":
                        continue
                    # dealt once between the joins and the distinct, so that no task holds the sorted fact and a table
                    # of pairs; by task as well, so that a very common pair is in many of them
                    rows = j.select(*levels, F.col(f"_v{i}").alias("_v"), F.spark_partition_id().alias("_task"))
                    pairs = rows.repartition(*levels, "_v", "_task").drop("_task").distinct()
                    one = _roll_up_distinct(pairs, levels, m.name)
                    out = one if out is None else align(out, one, levels + ["level"])
                return out.select(*levels, "level", *measures)
        types = dict(self.table(table).select(*levels).dtypes)
        out = None
        for i in range(n, -1, -1):
            r = self.evaluate(measures, [f"{table}.{c}" for c in levels[:i]], filters)
            for c in levels[i:]:
                r = r.withColumn(c, F.lit(None).cast(types[c]))
            r = r.withColumn("level", F.lit((1 << (n - i)) - 1).cast("bigint")).select(*levels, "level", *measures)
            out = r if out is None else out.unionByName(r)
        return out

    def summarize(self, table: str, by: list[str]) -> DataFrame:
        """Default aggregation: sum of every column flagged ``summarizeBy: sum`` of `table`."""
        cols = [_split(r)[1] for r, how in self.summarize_by.items() if _split(r)[0] == table and how == "sum"]
        return self.table(table).groupBy(*by).agg(*[F.sum(c).alias(f"sum_{c}") for c in cols])


# --- aggregation helpers -------------------------------------------------------

def _cond(c: Column, cond) -> Column:
    if isinstance(cond, Column):
        return cond
    if isinstance(cond, tuple) and cond and cond[0] == "between":
        return c.between(cond[1], cond[2])
    if isinstance(cond, (list, set, tuple)):
        return c.isin(list(cond))
    return c == cond


def _aggregate(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    v = F.col("_v")
    if kind == "sum":
        return df.groupBy(*keys).agg(F.sum(v).alias("_p0"))
    if kind == "count":
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_p0"))
    if kind == "avg":
        return df.groupBy(*keys).agg(F.sum(v).alias("_p0"), F.count(v).alias("_p1"))
    if kind == "distinct":
        return df.select(*keys, v).distinct()
    if kind.startswith("sketch"):
        return df.groupBy(*keys).agg(F.hll_sketch_agg(with_blank(v), F.lit(int(kind[6:]))).alias("_p0"))
    raise ValueError(kind)


def _reaggregate(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    if kind in ("sum", "count"):
        return df.groupBy(*keys).agg(F.sum("_p0").alias("_p0"))
    if kind == "avg":
        return df.groupBy(*keys).agg(F.sum("_p0").alias("_p0"), F.sum("_p1").alias("_p1"))
    if kind == "distinct":
        return df.select(*keys, "_v").distinct()
    if kind.startswith("sketch"):
        return df.groupBy(*keys).agg(F.hll_union_agg("_p0").alias("_p0"))
    raise ValueError(kind)


def with_blank(c: Column) -> Column:
    """A value as a string, with one of its own for NULL (DISTINCTCOUNT counts a NULL)."""
    return F.coalesce(c.cast("string"), F.lit("\u0000blank"))


def sketched(m: Measure, size: int) -> Measure:
    """A distinct count as mergeable HyperLogLog sketches of 2**size registers: the relative standard error of
    a count is 1.04 / sqrt(2**size)."""
    if m.kind != "distinct":
        raise ValueError(f"{m.name} is no distinct count")
    return replace(m, kind=f"sketch{size}")


def finalize(part: DataFrame, keys: list[str], kind: str, name: str) -> DataFrame:
    """Turn partials into the measure value."""
    if kind in ("sum", "count"):
        return part.select(*keys, F.col("_p0").alias(name))
    if kind == "avg":
        return part.select(*keys, F.try_divide(F.col("_p0"), F.col("_p1").cast("double")).alias(name))
    if kind == "distinct":
        return part.groupBy(*keys).agg(distinct_count_with_blank(F.col("_v")).alias(name))
    raise ValueError(kind)


def distinct_count_with_blank(c: Column) -> Column:
    """DISTINCTCOUNT semantics: a NULL counts as one more value when present."""
    return (F.count_distinct(c) + F.max(c.isNull().cast("int"))).cast("bigint")


def _roll_up_distinct(pairs: DataFrame, levels: list[str], name: str) -> DataFrame:
    """Distinct counts (a NULL counts as a value) at every prefix of `levels`, with ``level``, from the distinct
    (levels, _v) pairs.

    In the order of the levels, a value is new to a prefix where that prefix differs from the value's row
    before.  The marks of one pass add up to the members, and the members' sums along the roll-up, so
    no pair is copied for each level."""
    w = Window.partitionBy("_v").orderBy(*levels)
    marks, new = [], F.row_number().over(w) == 1
    for c in [None, *levels]:
        new = new if c is None else new | ~F.col(c).eqNullSafe(F.lag(c).over(w))
        marks.append(new.cast("bigint").alias(f"_m{len(marks)}"))
    members = pairs.select(*levels, *marks).groupBy(*levels).agg(*[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(marks))])
    rolled = members.rollup(*levels).agg(*[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(marks))], F.grouping_id().alias("level"))
    n = len(levels)
    count = F.coalesce(*[F.when(F.col("level") == (1 << (n - i)) - 1, F.col(f"_m{i}")) for i in range(n + 1)])
    return rolled.select(*levels, count.alias(name), "level")


def align(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe full outer join of two per-group results on `keys`."""
    if not keys:  # grand totals: one row each, joined on a constant key
        return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one", "full").drop("_one")
    ra = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys], *[c for c in a.columns if c not in keys])
    rb = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = None
    for k in keys:
        e = ra[f"_a_{k}"].eqNullSafe(rb[f"_b_{k}"])
        cond = e if cond is None else cond & e
    j = ra.join(rb, cond, "full")
    return j.select(*[F.coalesce(F.col(f"_a_{k}"), F.col(f"_b_{k}")).alias(k) for k in keys],
                    *[c for c in a.columns if c not in keys], *[c for c in b.columns if c not in keys])
