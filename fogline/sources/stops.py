"""Stop documents of any nesting depth -> normalised stop rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from fogline.functions.geo import point_wkt
from fogline.functions.text import strip_bom
from fogline.operators.latest import keep_last


@udtf(returnType="position: bigint, stop_id: string, stop_name: string, lon: double, lat: double")
class StopCandidates:
    """Objects with an id and a Location that has a longitude or latitude, in document order.

    Key names are matched without regard to case; the first match counts.
    """

    def eval(self, document: str) -> Iterator[tuple]:
        if document is None:
            return

        def get(node, key):
            return next((v for k, v in node.items() if k.lower() == key), None)

        def number(raw):
            try:
                return None if raw is None else float(raw)
            except (TypeError, ValueError):
                return None

        position = 0
        pending = [json.loads(document)]
        while pending:
            node = pending.pop()
            if isinstance(node, dict):
                location, stop_id = get(node, "location"), get(node, "id")
                if isinstance(location, dict) and stop_id is not None:
                    lon, lat = get(location, "longitude"), get(location, "latitude")
                    if lon is not None or lat is not None:
                        name = get(node, "name")
                        yield position, str(stop_id), None if name is None else str(name), number(lon), number(lat)
                        position += 1
                pending.extend(reversed(list(node.values())))
            elif isinstance(node, list):
                pending.extend(reversed(node))


def extract_stops(documents: DataFrame, text: str = "document", agency: str = "agency_id", order: str | None = None) -> DataFrame:
    """Documents (agency, JSON text) -> stops unique per (agency, stop), the last one kept.

    A stop needs both coordinates; ``order`` ranks several documents of one agency.
    """
    ranked = documents.select(
        F.col(agency).alias("agency_id"),
        (F.col(order) if order else F.lit(0)).alias("__doc"),
        strip_bom(F.col(text)).alias("__text"),
    )
    found = ranked.lateralJoin(StopCandidates(F.col("__text").outer()))
    located = found.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        "stop_id",
        "agency_id",
        "stop_name",
        "lat",
        "lon",
        F.struct("__doc", "position").alias("__position"),
    )
    unique = keep_last(located, ["agency_id", "stop_id"], "__position").drop("__position")
    return unique.withColumn("stop_point", point_wkt(F.col("lon"), F.col("lat")))
