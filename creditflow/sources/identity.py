"""C5 kept as a table: the client -> user map, maintained from the sessions since its last update.

The map is the set of (client_id, user_uuid) ever seen together.  Each update
reads only the sessions behind the watermark (less an allowance for late ones),
writes the pairs that the map hasn't got as a new part, and publishes the list
of parts with the new watermark by compare and set.  Parts are dealt by a hash
of the client id, so a lookup of few clients reads few files; ``compact``
rewrites them as one part.

A version names all its parts: what a crashed update has written is never read,
and an update that meets another one is worked out again.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.operators.orders import ts_lit
from creditflow.operators.touches import identity_map
from creditflow.sources.versions import Versions

SCHEMA = "client_id string, user_uuid string, bucket int"
BUCKETS = 64
LATE = dt.timedelta(days=2)


class IdentityMap:
    def __init__(self, spark: SparkSession, root: str, late: dt.timedelta = LATE):
        self.spark, self.root, self.late = spark, root.rstrip("/"), late
        self._versions = Versions(spark, f"{self.root}/versions")

    def _parts(self, content: dict | None) -> DataFrame:
        names = (content or {}).get("parts", [])
        if not names:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.root}/{n}" for n in names])

    def watermark(self) -> dt.datetime | None:
        """Start of the newest session that the map has taken in."""
        text = (self._versions.newest()[1] or {}).get("watermark")
        return None if text is None else dt.datetime.fromisoformat(text)

    def read(self) -> DataFrame:
        """(client_id, user_uuid), each pair once."""
        return self._parts(self._versions.newest()[1]).select("client_id", "user_uuid")

    def _write(self, pairs: DataFrame) -> str:
        """One folder a bucket would be too fine for a day's pairs: files are sorted by bucket for their statistics."""
        name = f"part-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64("client_id"), F.lit(BUCKETS)).cast("int")
        (pairs.select("client_id", "user_uuid", bucket.alias("bucket"))
         .repartitionByRange("bucket", "client_id").sortWithinPartitions("bucket", "client_id").write.parquet(f"{self.root}/{name}"))
        return name

    def update(self, sessions: DataFrame) -> dt.datetime | None:
        """Take in the sessions since the last update; the new watermark."""
        def work(content: dict | None) -> dict | None:
            known = (content or {}).get("watermark")
            fresh = sessions if known is None else sessions.where(F.col("visit_start_time") > ts_lit(dt.datetime.fromisoformat(known) - self.late))
            newest = fresh.agg(F.max("visit_start_time")).first()[0]
            if newest is None:
                return None
            pairs = identity_map(fresh.where(F.col("visit_start_time") <= ts_lit(newest)))
            have = self._parts(content).select(F.col("client_id").alias("_c"), F.col("user_uuid").alias("_u"))
            if content is not None:
                pairs = pairs.join(have, pairs["client_id"].eqNullSafe(F.col("_c")) & (pairs["user_uuid"] == F.col("_u")), "left_anti")
            mark = newest.isoformat() if known is None else max(known, newest.isoformat())
            return {"parts": [*(content or {}).get("parts", []), self._write(pairs)], "watermark": mark}

        self._versions.change(work)
        return self.watermark()

    def compact(self) -> None:
        """All parts as one; the old ones stay for readers of earlier versions."""
        self._versions.change(lambda c: None if c is None or len(c["parts"]) < 2 else dict(c, parts=[self._write(self._parts(c))]))
