"""The conversion ledger and its three-state delivery flag.

Pure DataFrame forms
--------------------
``append_rows``, ``mark_in_flight``, ``mark_delivered`` and ``undelivered``
are the row-level semantics: inserted rows carry ``sftp = NULL``; marking
turns NULL into FALSE (in flight); delivery turns FALSE into TRUE.

Persistent form
---------------
Plain parquet has no UPDATE, and rewriting the whole (ever-growing) ledger
for every state change would cost O(history) per run.  ``Ledger`` therefore
stores rows once, grouped in *batches* (one per insert), and keeps the
delivery state per batch in a small manifest.  All rows of a batch always
share one state: an insert starts a batch in NULL, marking moves every NULL
batch to FALSE, delivery moves every FALSE batch to TRUE, which is exactly the
row-level UPDATE semantics.  A seeded ledger with mixed states is split into
one batch per state.

Layout under ``root``::

    rows/batch=<n>/part-*.parquet      ledger columns without ``sftp``
    claims/<n>.json                    batch numbers that an insert has taken
    states/<version>.json              batch, sftp, n_rows, max_time of every batch

Every change publishes one new manifest by compare and set
(``creditflow.sources.versions``), worked out again when another writer came
first, so concurrent writers lose nothing and a step that fails anywhere leaves
the state before it and can be rerun.  An insert claims a batch number of its
own before it writes and registers the rows of that number only: rows that a
crashed insert left behind are never read, and an insert without rows
registers nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditflow.functions.timeutil import format_ts
from creditflow.operators.joins import bounded_broadcast
from creditflow.schemas import LEDGER, LEDGER_COLUMNS
from creditflow.sources.versions import Folder, Versions

ROW_COLUMNS = [c for c in LEDGER_COLUMNS if c != "sftp"]
ROWS = T.StructType([f for f in LEDGER.fields if f.name != "sftp"]
                    + [T.StructField("batch", T.IntegerType())])
STATES = T.StructType([T.StructField("batch", T.IntegerType()), T.StructField("sftp", T.BooleanType()),
                       T.StructField("n_rows", T.LongType()),
                       T.StructField("max_time", T.TimestampNTZType())])


# ---------------------------------------------------------------------------
# Row-level semantics.
# ---------------------------------------------------------------------------

def to_ledger_rows(conversions: DataFrame) -> DataFrame:
    """Conversion rows in ledger column order with ``sftp = NULL``."""
    return conversions.select(*[F.col(f.name).cast(f.dataType) if f.name != "sftp"
                                else F.lit(None).cast("boolean").alias("sftp") for f in LEDGER.fields])


def append_rows(ledger: DataFrame, conversions: DataFrame) -> DataFrame:
    """S2 as a DataFrame: the ledger after inserting ``conversions``."""
    return ledger.select(*LEDGER_COLUMNS).unionByName(to_ledger_rows(conversions))


def mark_in_flight(ledger: DataFrame) -> DataFrame:
    """``SET sftp = FALSE WHERE sftp IS NULL``."""
    return ledger.withColumn("sftp", F.when(F.col("sftp").isNull(), F.lit(False)).otherwise(F.col("sftp")))


def mark_delivered(ledger: DataFrame) -> DataFrame:
    """``SET sftp = TRUE WHERE sftp IS FALSE``."""
    return ledger.withColumn("sftp", F.when(F.col("sftp").eqNullSafe(False), F.lit(True))
                             .otherwise(F.col("sftp")))


def undelivered(ledger: DataFrame) -> DataFrame:
    """S3: in-flight rows with the time as ``YYYY-MM-DD HH24:MI:SS`` text."""
    return (ledger.where(F.col("sftp").eqNullSafe(False))
            .select("gcl_id", "conversion_name", format_ts("conversion_time").alias("conversion_time"),
                    "attributed_credit", "conversion_value", "conversion_currency"))


# ---------------------------------------------------------------------------
# Persistent ledger.
# ---------------------------------------------------------------------------

class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.rows_path = f"{self.root}/rows"
        self._states = Versions(spark, f"{self.root}/states")
        self._claims = Versions(spark, f"{self.root}/claims", keep=1 << 31)

    # -- reading ---------------------------------------------------------
    def _batches(self) -> list[dict]:
        return (self._states.newest()[1] or {"batches": []})["batches"]

    def states(self) -> DataFrame:
        rows = [(b["batch"], b["sftp"], b["n_rows"], _time(b["max_time"])) for b in self._batches()]
        return self.spark.createDataFrame(rows, STATES)

    def read(self) -> DataFrame:
        """The ledger (``LEDGER`` schema): rows joined to their batch state."""
        st = self.states()
        if not Folder(self.spark, self.rows_path).exists():
            return self.spark.createDataFrame([], LEDGER)
        rows = self.spark.read.schema(ROWS).parquet(self.rows_path)
        return rows.join(bounded_broadcast(st.select("batch", "sftp")), "batch").select(*LEDGER_COLUMNS)

    def high_water_mark(self):
        """C1 from the batch metadata (no scan of the rows)."""
        return max((t for t in (_time(b["max_time"]) for b in self._batches()) if t is not None), default=None)

    # -- writing ---------------------------------------------------------
    def _claim(self) -> int:
        """A batch number that no other attempt has or will get."""
        while True:
            written = [int(n.partition("=")[2]) for n in Folder(self.spark, self.rows_path).names() if n.startswith("batch=")]
            taken = [*written, *self._claims.numbers(), *(b["batch"] for b in self._batches())]
            number = 1 + max(taken, default=-1)
            if self._claims.publish(number, {}):
                return number

    def _write_batch(self, rows: DataFrame, batch: int) -> DataFrame:
        (rows.select(*ROW_COLUMNS).withColumn("batch", F.lit(batch))
         .write.mode("append").partitionBy("batch").parquet(self.rows_path))
        written = (self.spark.read.schema(ROWS).parquet(self.rows_path).where(F.col("batch") == batch)
                   .groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.max("conversion_time").alias("max_time")))
        return written

    def _new_batch(self, rows: DataFrame, state: bool | None) -> tuple[int, list[dict]]:
        """Rows written under a number of their own, and what the manifest will say of them."""
        batch = self._claim()
        meta = [{"batch": batch, "sftp": state, "n_rows": r["n_rows"], "max_time": r["max_time"] and r["max_time"].isoformat()}
                for r in self._write_batch(rows, batch).collect()]
        if not meta:
            self._claims.folder.delete(f"{batch:012d}.json")
        return batch, meta

    def create(self, initial: DataFrame | None = None) -> "Ledger":
        """Start a ledger, optionally seeded with rows in any delivery state; refuses where one exists."""
        if self._states.numbers():
            raise FileExistsError(f"{self.root} holds a ledger")
        batches = []
        for state in (None, False, True) if initial is not None else ():
            part = initial.where(F.col("sftp").isNull() if state is None else F.col("sftp") == state)
            batches += self._new_batch(part, state)[1]
        if not self._states.publish(1, {"batches": batches}):
            raise FileExistsError(f"{self.root} holds a ledger")
        return self

    def append(self, conversions: DataFrame) -> int:
        """Insert conversion rows as a new batch in state NULL; returns the batch id."""
        batch, meta = self._new_batch(to_ledger_rows(conversions), None)
        if meta:
            self._states.change(lambda m: {"batches": (m or {"batches": []})["batches"] + meta})
        return batch

    def _move(self, old: bool | None, new: bool) -> None:
        def work(m):
            batches = (m or {"batches": []})["batches"]
            if not any(b["sftp"] is old for b in batches):
                return None
            return {"batches": [dict(b, sftp=new) if b["sftp"] is old else b for b in batches]}
        self._states.change(work)

    def mark_in_flight(self) -> None:
        """D1 on the batch states."""
        self._move(None, False)

    def mark_delivered(self) -> None:
        """D2 on the batch states."""
        self._move(False, True)


def _time(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)
