"""Folders of odd tables: empty ones, and ones with NULLs everywhere, repeated rows and clashing extra columns."""

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq

#: Names the operators use inside.
CLASHES = (
    "key", "n", "a", "b", "c", "v", "w", "p", "m", "k", "t", "e", "cid", "code", "fid", "term", "tid", "word", "ref", "edits", "entry", "slot", "label", "node", "component", "rank", "running", "first", "batch",
    "start", "length", "part", "tokens", "rate", "block", "held", "prob", "copies", "status", "kind", "id", "live", "month", "month_", "unit", "options", "residual", "grp", "place", "view", "ord", "loc", "i",
)


def _write(table: pa.Table, folder: str, name: str) -> None:
    os.makedirs(folder, exist_ok=True)
    pq.write_table(table, f"{folder}/{name}.parquet")


def empty(source: str, folder: str) -> str:
    for f in glob.glob(f"{source}/*.parquet"):
        _write(pq.read_table(f).slice(0, 0), folder, os.path.basename(f)[:-8])
    return folder


def odd(source: str, folder: str, rows: int = 25) -> str:
    """The first rows twice, a row of NULLs, and extra text columns under every clashing name."""
    for f in glob.glob(f"{source}/*.parquet"):
        name = os.path.basename(f)[:-8]
        table = pq.read_table(f)
        some = table.slice(0, rows)
        nulls = pa.table({c: pa.nulls(1, table.schema.field(c).type) for c in table.column_names})
        table = table if name in ("pack_sizes", "mix_targets", "view_list", "region", "nation") else pa.concat_tables([some, some, nulls.cast(some.schema)])
        for c in CLASHES:
            if c not in table.column_names:
                table = table.append_column(c, pa.array(["clash"] * len(table)))
        _write(table, folder, name)
    return folder
