"""Typed table contracts: column order, types and required values, checked at write and read.

``checked`` compares names, order and types when a plan is built (no job).  ``enforced``
also makes every required column raise inside the writing job as soon as it meets a NULL, so a
table on disk never holds one.  ``verify`` counts the NULLs of the required columns of a
table that another program may have written.  Every error names the table and the column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velostat.schema import CURATED_TRIPS_SCHEMA, DQ_LOG_SCHEMA, STATIONS_SCHEMA, TRIPS_SCHEMA


class ContractError(ValueError):
    """A table does not have the columns, types or values that its contract asks for."""


@dataclass(frozen=True)
class Contract:
    table: str
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    def _fail(self, column: str, what: str) -> None:
        raise ContractError(f"table {self.table}, column {column}: {what}")

    def checked(self, df: DataFrame, partitions: tuple[str, ...] = ()) -> DataFrame:
        """``df`` if it has exactly these columns, in this order and of these types; columns named
        in ``partitions`` may follow."""
        types = dict(df.dtypes)
        for f in self.schema:
            if f.name not in types:
                self._fail(f.name, "missing")
            if types[f.name] != f.dataType.simpleString():
                self._fail(f.name, f"is {types[f.name]}, not {f.dataType.simpleString()}")
        for name in df.columns:
            if name not in self.columns and name not in partitions:
                self._fail(name, "not a column of this table")
        for place, (name, found) in enumerate(zip(self.columns, df.columns)):
            if name != found:
                self._fail(found, f"stands at place {place + 1}, where {name} belongs")
        return df

    def enforced(self, df: DataFrame) -> DataFrame:
        """``df`` for writing: checked, and a NULL in a required column fails the job."""
        self.checked(df)
        message = lambda c: F.raise_error(F.lit(f"table {self.table}, column {c}: NULL in a required column"))
        return df.withColumns({c: F.when(F.col(c).isNull(), message(c)).otherwise(F.col(c)) for c in self.required})

    def verify(self, df: DataFrame) -> DataFrame:
        """``df`` if no required column holds a NULL (one aggregate over these columns)."""
        if self.required:
            found = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in self.required]).first()
            for c in self.required:
                if found[c]:
                    self._fail(c, f"NULL in {found[c]} rows")
        return df


SILVER_TRIPS = Contract("silver trips", TRIPS_SCHEMA)
CURATED_TRIPS = Contract("trips", CURATED_TRIPS_SCHEMA)
STATIONS = Contract("stations", STATIONS_SCHEMA)
DQ_LOG = Contract("data quality log", DQ_LOG_SCHEMA)
