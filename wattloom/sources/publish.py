"""Which output is written in which run mode."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.sources.tables import write_table

# Parallel writers of ordinary and of large tables.
WRITERS, WIDE_WRITERS = 70, 140


@dataclass(frozen=True)
class Output:
    """Run modes in which a table is written, and how."""

    modes: frozenset[int]
    mode: str
    partition_by: tuple[str, ...] = ()
    wide: bool = False

    @property
    def width(self) -> int:
        """Number of parallel writers into a database."""
        return WIDE_WRITERS if self.wide else WRITERS


def _output(modes: set[int], mode: str, partition_by: tuple[str, ...] = (), wide: bool = False) -> Output:
    return Output(frozenset(modes), mode, partition_by, wide)


_SEASON = ("season", "daytype")
_ALL = {1, 2, 3, 4}

# Outputs by run mode. 1 computes and keeps curves and hour groups, 2 fills the
# star schema, 3 fills the quality tables, 4 fills the modelling tables.
OUTPUTS: dict[str, Output] = {
    "datetimeinterval": _output({2}, "append"),
    "volt": _output({2}, "append", wide=True),
    "voltagelow": _output({3}, "errorifexists"),
    "voltagehigh": _output({3}, "errorifexists"),
    "voltageout": _output({3}, "errorifexists"),
    "basereading": _output({2}, "append", wide=True),
    "identifiedobject": _output({2}, "overwrite"),
    "enddevice": _output({2}, "append"),
    "meter": _output({2}, "append"),
    "voltoutsum": _output({2}, "append"),
    "pvcurve": _output({2, 3}, "append", _SEASON),
    "qvcurve": _output({2, 3}, "append", _SEASON),
    "pvsd": _output({1}, "overwrite", _SEASON),
    "qvsd": _output({1}, "overwrite", _SEASON),
    "pqvcf": _output({4}, "errorifexists", wide=True),
    "meterids": _output({1, 4}, "overwrite"),
    "hourgroup": _output({1}, "append"),
    "irregular": _output({1}, "append"),
    "pvsdhg": _output({4}, "append", wide=True),
    "hourgroup2": _output(_ALL, "overwrite"),
    "pvsdhg2": _output(_ALL, "overwrite", wide=True),
    "qvsdhg2": _output(_ALL, "overwrite", wide=True),
    "pvhg": _output({4}, "append"),
}


RUN = "run"


def file_sink(folder: str, run: str) -> Callable[[str, DataFrame, Output], int]:
    """A sink that writes Parquet tables under ``folder`` and may be repeated.

    What a rule appends is kept per ``run``, in a directory of that name: another run adds its
    rows, the same run replaces them. A rule that overwrites replaces the table, and one that
    must not find a table lets the same run replace it.
    """

    def sink(name: str, df: DataFrame, rule: Output) -> int:
        path = f"{folder.rstrip('/')}/{name}"
        if rule.mode == "overwrite":
            return write_table(df, path, mode="overwrite", partition_by=rule.partition_by)
        return write_table(
            df.withColumn(RUN, F.lit(run)), path, partition_by=(RUN, *rule.partition_by), replace_partitions=True
        )

    return sink


def publish(
    tables: Mapping[str, DataFrame],
    run_mode: int,
    sink: Callable[[str, DataFrame, Output], int | None],
) -> dict[str, int | None]:
    """Hands every table due in ``run_mode`` to ``sink``; returns what it says of each, its rows.

    The rule that comes with a table tells its write mode, layout and ``width``. The tables are
    lazy, so outputs that a mode does not write cost nothing.
    """
    unknown = set(tables) - set(OUTPUTS)
    if unknown:
        raise KeyError(f"no such output: {', '.join(sorted(unknown))}")
    return {name: sink(name, df, OUTPUTS[name]) for name, df in tables.items() if run_mode in OUTPUTS[name].modes}
