"""Exact ``ntile`` over a whole table by counting, without sorting it.

Only the last row of each tile matters. Counts per range of values tell in which range it
lies; that range is cut again, until it holds few rows or a single value. Rows of a single
value are told apart by id, in the same way. A step is one map-side combined aggregation of
at most TILE ENDS x RANGES groups, however many rows there are. In the end every row is
labelled by comparing it with those few rows, which is a plain projection.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

RANGES = 1024  # cuts of a range per step
FEW = 2000  # rows of a range that are looked at one by one


@dataclass(frozen=True)
class Search:
    """Where the row of number ``rank`` (from 1) among the rows of ``where`` lies.

    ``low`` to ``high`` are the ends of ``by``, the column that is cut now, and ``rows`` how
    many rows lie there. A search by key goes on by id once only one value is left.
    """

    name: str
    rank: int
    where: Column
    by: Column
    low: object
    high: object
    rows: int
    by_id: bool = False

    def within(self) -> Column:
        return self.where & self.by.between(F.lit(self.low), F.lit(self.high))

    def part(self) -> Column:
        """Number of the cut a row lies in: never falling with ``by``."""
        width = self.high - self.low
        # A difference of whole numbers is exact unless it would not fit into a long.
        by, low = (self.by, self.low) if width < 2**62 else (self.by.cast("double"), float(self.low))
        return F.least(F.floor((by - F.lit(low)) / F.lit(float(width)) * RANGES), F.lit(RANGES - 1))


def _number(column, df):
    """The column as long or double, which literals and differences keep exact."""
    kind = df.select(column.alias("c")).schema["c"].dataType
    if isinstance(kind, T.IntegralType):
        return column.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.cast("double")
    raise TypeError(f"tiles are counted over whole numbers or doubles, not {kind.simpleString()}")


def ntile(df: DataFrame, id_col: str, scores: dict, tiles: int) -> DataFrame:
    """Add one tile column per entry of ``scores``.

    ``scores`` maps the new column to a numeric sort column, ascending, nulls lowest;
    ``id_col`` is a unique number and breaks ties. ``df`` is read a few times, so pass a
    stored table.
    """
    ident = _number(F.col(id_col), df)
    keys = {name: _number(key, df) for name, key in scores.items()}
    edges = _last_rows(df, ident, keys, tiles)
    return df.select("*", *[_tile(key, ident, edges[name]).alias(name) for name, key in keys.items()])


def _tile(key, ident, edges):
    """1 + the number of tile-ending rows that come before this row; nulls compare lowest."""
    row = F.struct(key.alias("key"), ident.alias("id"))
    tile = F.lit(1)
    for last_key, last_id in edges:
        last = F.struct(last_key.alias("key"), last_id.alias("id"))
        tile = tile + (row > last).cast("int")
    return tile


def _tile_ends(rows, tiles):
    """Row numbers (from 1) of the last row of every tile but the final one."""
    size, longer = divmod(rows, tiles)
    ends = [k * size + min(k, longer) for k in range(1, tiles)]
    return [e for e in ends if 0 < e < rows]


def _last_rows(df, ident, keys, tiles):
    """Per score, (key, id) literals of the last row of each tile but the final one."""
    found = df.agg(
        F.count(F.lit(1)).alias("rows"), F.min(ident).alias("low"), F.max(ident).alias("high"),
        *[F.struct(F.count(k).alias("known"), F.min(k).alias("low"), F.max(k).alias("high")).alias(name)
          for name, k in keys.items()]).first()
    searches = []
    for name, key in keys.items():
        nulls = found["rows"] - found[name].known
        for rank in _tile_ends(found["rows"], tiles):
            if rank <= nulls:
                searches.append(Search(name, rank, key.isNull(), ident, found.low, found.high, nulls, True))
            else:
                searches.append(Search(name, rank - nulls, F.lit(True), key,
                                       found[name].low, found[name].high, found[name].known))
    while any(s.rows > FEW for s in searches):
        searches = _narrowed(df, ident, searches)
    return _looked_up(df, ident, keys, searches)


def _narrowed(df, ident, searches):
    """Each search with many rows, cut once; one aggregation for all of them."""
    out = list(searches)
    cut = {k: s for k, s in enumerate(searches) if s.rows > FEW}
    single = [k for k, s in cut.items() if s.low == s.high and not s.by_id]
    if single:  # told apart by id from here on: from where to where do the ids reach?
        ids = {k: F.when(cut[k].within(), ident) for k in single}
        spans = df.agg(*[F.struct(F.min(i).alias("low"), F.max(i).alias("high")).alias(str(k)) for k, i in ids.items()]).first()
        for k in single:
            low, high = spans[str(k)]
            cut[k] = replace(cut[k], where=cut[k].within(), by=ident, by_id=True, low=low, high=high)
    kinds = {k: "double" if isinstance(s.low, float) else "long" for k, s in cut.items()}
    places = [
        F.when(s.within(), F.struct(
            F.lit(k).alias("search"), s.part().alias("part"),
            *[(s.by if kinds[k] == kind else F.lit(None)).cast(kind).alias(kind) for kind in ("long", "double")]))
        for k, s in cut.items()]
    parts = df.select(F.explode(F.array_compact(F.array(*places))).alias("p")).groupBy("p.search", "p.part").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(F.col(f"p.{kind}")).alias(f"{end}_{kind}") for kind in ("long", "double")
          for end, f in (("low", F.min), ("high", F.max))])
    by_search = {}
    for r in parts.collect():
        by_search.setdefault(r.search, []).append(r)
    for k, s in cut.items():
        before = 0
        for r in sorted(by_search[k], key=lambda r: r.part):
            if s.rank <= before + r.rows:
                out[k] = replace(s, rank=s.rank - before, rows=r.rows, low=r[f"low_{kinds[k]}"], high=r[f"high_{kinds[k]}"])
                break
            before += r.rows
    return out


def _looked_up(df, ident, keys, searches):
    """(key, id) literals of the rows sought; each search is left with FEW rows at most."""
    edges = {name: [] for name in keys}
    if not searches:
        return edges
    places = [F.when(s.within(), F.struct(F.lit(k).alias("search"), ident.alias("id"),
                                          *[keys[name].alias(name) for name in keys]))
              for k, s in enumerate(searches)]
    rows = df.select(F.explode(F.array_compact(F.array(*places))).alias("p")).select("p.*").collect()
    kinds = dict(df.select(ident.alias("id"), *[key.alias(name) for name, key in keys.items()]).dtypes)
    for k, s in enumerate(searches):
        own = [r for r in rows if r.search == k]
        own.sort(key=lambda r: (r[s.name] is not None, r[s.name] if r[s.name] is not None else 0, r.id))
        last = own[s.rank - 1]
        edges[s.name].append([F.lit(last[c]).cast(kinds[c]) for c in (s.name, "id")])
    return edges
