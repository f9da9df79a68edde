"""Long to wide and back.

A wide table is built in two narrow shuffles. The first reduces every cell to one value
(map-side combine, so a session that was delivered many times is already small). The
second brings the cells of a session together. There they are sorted, which spills, and laid
out a batch of rows at a time: a task holds narrow cells, and full-width rows of one batch only,
while a pivot's hash table would hold the full-width, mostly empty rows of all its sessions.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from parcelhouse.functions import measured_value
from parcelhouse.model import (
    SESSION_KEYS,
    region_column,
    value_column,
)


#: Cells of a batch of wide rows, filled or empty.
_BATCH_CELLS = 1 << 20


def region_list(df: DataFrame, column: str) -> list:
    """Sorted region names, read from the data. Names become columns: they are schema."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    names = sorted(str(r[0]) for r in rows)
    if len({n.lower() for n in names}) != len(names):
        raise ValueError("region names that differ only in case are ambiguous columns")
    return names


def _first(value: str, order=None) -> Column:
    if order is None:
        return F.first(value, ignorenulls=True)
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), rank))


def first_values(df: DataFrame, keys, values, order=None) -> DataFrame:
    """First non-null value per key and column, in ``order`` if given."""
    return df.groupBy(*keys).agg(*[_first(v, order).alias(v) for v in values])


def to_wide(
    df: DataFrame, column: str, values, regions=None, order=None, index=SESSION_KEYS, unique=False
) -> DataFrame:
    """One row per ``index``, one column per region (``{region}_{value}`` for several values).

    Rows and columns without any value do not appear, and rows with a null key are left out.
    Where cells are ``unique``, or nearly so, a row's cells are as many as its regions, and one shuffle
    brings them together. Given ``regions`` leave out other cells, but no rows.
    """
    values = [values] if isinstance(values, str) else list(values)
    any_value = F.coalesce(*[F.col(v) for v in values]).isNotNull()
    known = df.where(any_value).dropna(subset=[*index, column])
    if regions is None:
        # Names only: a scan of the columns that decide, reduced before it leaves the tasks.
        regions = region_list(known, column)
    keys = [*index, column]
    if unique:
        cells = first_values(known.repartition(*index), keys, values, order)
    else:
        cells = first_values(known, keys, values, order).repartition(*index)
    cells = cells.select(*index, F.col(column).cast("string"), *values).sortWithinPartitions(*index)
    names = [str(r) for r in regions]
    wide = [
        StructField(n if len(values) == 1 else f"{n}_{v}", cells.schema[v].dataType)
        for n in names for v in values
    ]
    schema = StructType([*cells.schema.fields[: len(index)], *wide])
    return cells.mapInArrow(_laid_out(len(index), names, schema.names), schema)


def to_wide_by_value(cells: DataFrame, column: str, values, regions, index, tag: str) -> DataFrame:
    """Wide rows of several values below each other: one for each of ``values`` that a row of ``index`` has,
    named by ``tag``, with one column per region.

    Cells are unique, those of a row lie in one partition and follow each other; no key is null. Rows
    leave a partition as they come: nothing is shuffled once it is wide.
    """
    cells = cells.select(*index, F.col(column).cast("string"), *[F.col(v).cast("double") for v in values])
    schema = StructType(
        [*cells.schema.fields[: len(index)], StructField(tag, StringType(), False)]
        + [StructField(str(r), DoubleType()) for r in regions]
    )
    rows = _stacked(len(index), [str(r) for r in regions], list(values), schema.names)
    return cells.mapInArrow(rows, schema)


def _stacked(width: int, names: list, values: list, columns: list):
    """Cells to wide rows, one for each value that is there; one value after the other, as files hold them."""
    step = max(1, _BATCH_CELLS // max(1, len(names)))

    def rows(cells, first):
        keys = [c.combine_chunks() for c in cells.columns]
        place = pc.fill_null(pc.index_in(keys[width], pa.array(names, keys[width].type)), -1).to_numpy()
        for value, cell in zip(values, keys[width + 1 :]):
            there = cell.is_valid().to_numpy(zero_copy_only=False) & (place >= 0)
            number = cell.to_numpy(zero_copy_only=False)
            for a in range(0, len(first), step):
                low = first[a : a + step]
                high = first[a + step] if a + step < len(first) else cells.num_rows
                used = np.flatnonzero(there[low[0] : high])
                if not len(used):
                    continue
                row = np.repeat(np.arange(len(low)), np.diff(low, append=high))
                filled, at = np.unique(row[used], return_inverse=True)
                used += low[0]
                wide = np.zeros((len(names), len(filled)))
                empty = np.ones(wide.shape, bool)
                wide[place[used], at] = number[used]
                empty[place[used], at] = False
                chosen = pa.array(low[filled])
                out = [k.take(chosen) for k in keys[:width]]
                out.append(pa.repeat(value, len(filled)))
                out.extend(pa.array(c, mask=e) for c, e in zip(wide, empty))
                yield pa.RecordBatch.from_arrays(out, names=columns)

    return _session_by_session(width, rows, _BATCH_CELLS // max(1, len(values)))


def _laid_out(width: int, names: list, columns: list):
    """Cells sorted by their first ``width`` columns to wide rows; unique by these and the name after them."""
    step = max(1, _BATCH_CELLS // max(1, len(columns) - width))

    def rows(cells, first):
        """Wide rows of whole sessions, which begin at the cells ``first``."""
        keys = [c.combine_chunks() for c in cells.columns]
        place = pc.fill_null(pc.index_in(keys[width], pa.array(names, keys[width].type)), -1).to_numpy()
        for a in range(0, len(first), step):
            low = first[a : a + step]
            high = first[a + step] if a + step < len(first) else cells.num_rows
            row = np.repeat(np.arange(len(low)), np.diff(low, append=high))
            wanted = place[low[0] : high]
            used = np.flatnonzero(wanted >= 0)
            cell = np.full((len(names), len(low)), -1)
            cell[wanted[used], row[used]] = low[0] + used
            out = [k.take(pa.array(low)) for k in keys[:width]]
            for at in cell:
                at = pa.array(at, mask=at < 0)
                out.extend(v.take(at) for v in keys[width + 1 :])
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return _session_by_session(width, rows)


def _session_by_session(width: int, rows, least=1):
    """Cells whose sessions (the first ``width`` columns) lie together, given to ``rows`` as whole sessions of
    ``least`` cells or more."""

    def starts(cells):
        new = np.ones(cells.num_rows, bool)
        new[1:] = False
        for key in cells.columns[:width]:
            new[1:] |= pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy()
        return np.flatnonzero(new)

    def lay_out(batches):
        held = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= least:
                cells = pa.concat_tables(held)
                first = starts(cells)
                yield from rows(cells.slice(0, first[-1]), first[:-1])
                held = [cells.slice(first[-1])]
        if any(t.num_rows for t in held):
            cells = pa.concat_tables(held)
            yield from rows(cells, starts(cells))

    return lay_out


def to_value_map(df: DataFrame, column, value: str, order=None, index=SESSION_KEYS) -> DataFrame:
    """The wide row as one ``map<region, value>``; for more regions than a schema bears."""
    name = F.col(column) if isinstance(column, str) else column
    known = df.select(*index, name.alias("_name"), *( [value] + list(order or ()) ))
    known = known.where(F.col(value).isNotNull()).dropna(subset=[*index, "_name"])
    cells = first_values(known, [*index, "_name"], [value], order)
    return cells.groupBy(*index).agg(
        F.map_from_entries(F.collect_list(F.struct("_name", value))).alias("values")
    )


def anatomical_feature_name() -> Column:
    return F.concat_ws("_", "modality", "metric", "label")


def combined_anatomical(df, modalities=("gm", "wm", "ct"), names=None, order=None) -> DataFrame:
    """All tissue measures in one table, columns ``{modality}_{metric}_{label}``."""
    chosen = (
        df.where(F.col("modality").isin(*modalities))
        .dropna(subset=["modality", "metric", "label"])
        .withColumn("_feature", anatomical_feature_name())
        .withColumn("_value", measured_value())
    )
    return to_wide(chosen, "_feature", "_value", names, order)


def combined_diffusion(
    df, workflows=None, region=None, value=None, names=None, order=None
) -> DataFrame:
    """All diffusion measures in one table, columns ``{workflow}_{model}_{param}_{region}``."""
    region = region_column(df.columns, region or "name")
    value = value_column(df.columns, value or "mean")
    parts = ["workflow", "model", "param", region]
    chosen = df if workflows is None else df.where(F.col("workflow").isin(*workflows))
    chosen = chosen.dropna(subset=parts).withColumn("_feature", F.concat_ws("_", *parts))
    return to_wide(chosen, "_feature", value, names, order)


def to_tidy(wide: DataFrame, metric: str, statistic: str, ids=("participant_id",)) -> DataFrame:
    """Wide to ``(ids, parcel, metric, value, statistic)``, nulls included."""
    regions = [c for c in wide.columns if c not in ids]
    return (
        wide.unpivot(list(ids), [F.col(f"`{c}`") for c in regions], "parcel", "value")
        .withColumn("metric", F.lit(metric))
        .withColumn("statistic", F.lit(statistic))
        .select(*ids, "parcel", "metric", "value", "statistic")
    )


def flatten_quality_record(
    df: DataFrame, ids, record: str, blocks=("qualitymeasures", "qualityratings")
) -> DataFrame:
    """Numeric leaves of some blocks of a JSON record, as ``(ids, measure, value)`` rows.

    Each block is read by itself, so what else a record holds doesn't matter; quoted numbers
    are texts and left out.
    """
    leaves = [
        F.when(
            F.col(record).isNotNull(),
            F.from_json(F.get_json_object(record, f"$.{b}"), "map<string,variant>"),
        )
        for b in blocks
    ]
    found = None
    for block, leaf in zip(blocks, leaves):
        part = df.select(
            *ids, F.lit(block).alias("_block"), F.explode(leaf).alias("_leaf", "_value")
        )
        found = part if found is None else found.unionByName(part)
    number = F.schema_of_variant("_value").rlike("^(BIGINT|DOUBLE|DECIMAL)")
    return found.where(number).select(
        *ids,
        F.concat_ws("_", "_block", "_leaf").alias("measure"),
        F.try_variant_get("_value", "$", "double").alias("value"),
    )
