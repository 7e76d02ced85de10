"""Small builders for test rows."""

from __future__ import annotations

from entitylog import schema


def node(id, host="localhost", port=9092, rack=None):
    return {"id": id, "host": host, "port": port, "rack": rack}


def partition(id, leader, replicas=None, isr=None):
    held = [leader] if replicas is None else replicas
    return {"id": id, "leader": leader, "replicas": held, "isr": held if isr is None else isr}


def description(internal=False, partitions=()):
    return {"internal": internal, "partitions": list(partitions)}


def events(spark, *rows):
    """Events from (kind, op, payload) in log order."""
    data = []
    for i, (kind, op, payload) in enumerate(rows):
        id = payload["name" if kind == schema.TOPIC else "id"]
        event = dict.fromkeys(schema.EVENT.fieldNames())
        event.update(entity_type=kind, entity_id=id, op=op, op_tag=op, round=i, seq=0)
        event[schema.ARM[kind]] = payload
        data.append(event)
    return spark.createDataFrame(data, schema.EVENT)


def topic(name, described=None, config=None):
    return {"name": name, "description": described, "config": config}


def snapshot(spark, kind, *rows):
    names = schema.SNAPSHOT[kind].fieldNames()
    return spark.createDataFrame([{n: r.get(n) for n in names} for r in rows], schema.SNAPSHOT[kind])


def state(spark, kind, *rows):
    names = schema.STATE[kind].fieldNames()
    return spark.createDataFrame([{n: r.get(n) for n in names} for r in rows], schema.STATE[kind])


def table(df, *columns):
    """Rows of some columns as a sorted list."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))
