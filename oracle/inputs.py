"""Banking views over the supplied tables: in_<entity> as generated, br_<entity> with year and month."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerline.model import ENTITIES
from ledgerline.sources.banking_views import CARD_KIND, VIEWS

KINDS = {T.LongType: "BIGINT", T.StringType: "VARCHAR", T.DoubleType: "DOUBLE", T.DateType: "DATE",
         T.TimestampNTZType: "TIMESTAMP"}

JOINS = {
    "customers": "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
    "merchants": "LEFT JOIN nation ON s_nationkey = n_nationkey",
}


def _input(entity: str) -> str:
    view = VIEWS[entity]
    base = f"SELECT {view.key} AS k, t.* FROM {view.source} t"
    if entity == "cards":
        base = (f"SELECT b.*, {CARD_KIND} AS ct FROM (SELECT event_id AS k, t.*, o_orderpriority "
                f"FROM events t LEFT JOIN orders ON o_orderkey = event_id) b")
    rows = f"({base})"
    if view.twice:
        rows = f"({base} UNION ALL SELECT * FROM ({base}) WHERE {view.twice})"
    columns = ", ".join(
        f"CAST({view.columns[field.name]} AS {KINDS[type(field.dataType)]}) AS {field.name}"
        for field in ENTITIES[entity].columns.fields
    )
    return f"SELECT {columns} FROM {rows} x {JOINS.get(entity, '')}"


INPUTS = {f"in_{name}": _input(name) for name in ENTITIES}
INPUTS.update({
    f"br_{name}": (
        f"SELECT *, CAST(year({entity.date_column}) AS INTEGER) AS year, "
        f"CAST(month({entity.date_column}) AS INTEGER) AS month FROM in_{name}"
    )
    for name, entity in ENTITIES.items()
})
