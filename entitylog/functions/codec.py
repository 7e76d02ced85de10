"""Event payloads as bytes: JSON, or Protocol Buffers for other consumers.

An event is reshaped into its message, a struct with the fields the record
format has, and the message is written as bytes; reading goes the other way.
JSON stays inside the JVM. Protocol Buffers bytes are made in Arrow batches and
need the ``google.protobuf`` Python package on the executors.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylog.functions.canon import canon, config_from_entries, config_to_entries
from entitylog.schema import (
    ARM,
    BOOL,
    BROKER,
    CLUSTER,
    CREATED,
    DESCRIPTION,
    EVENT,
    INT,
    NODE,
    OPERATIONS,
    STRING,
    TOPIC,
    UPDATED,
    ArrayType,
    StructType,
    struct,
)

# Executors get the functions of this module with the job, and need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What the payload holds; the position in the log is kept beside it.
PAYLOAD = struct(
    **{f.name: f.dataType for f in EVENT.fields if f.name not in ("op_tag", "round", "seq")}
)

# Messages of the record format, as field number, name and type.
# A trailing * marks a repeated field, a leading | a member of the one-of. The
# field of Empty is never set; a struct needs one.
MESSAGES = {
    "Event": [
        "1 entity_type int32", "2 entity_id string",
        "3 |cluster ClusterEvent", "4 |broker BrokerEvent", "5 |topic TopicEvent",
    ],
    "ClusterEvent": ["1 id string", "2 |Created ClusterValue", "3 |Updated ClusterValue"],
    "ClusterValue": ["1 controller Node"],
    "BrokerEvent": ["1 id string", "2 |Created BrokerValue", "3 |Updated BrokerValue"],
    "BrokerValue": ["1 node Node", "2 config Config"],
    "TopicEvent": ["1 name string", "2 |Created Empty", "3 |Updated TopicValue", "4 |Deleted Empty"],
    "TopicValue": ["1 description Description", "2 config Config"],
    "Description": ["1 internal bool", "2 partitions Partition*"],
    "Partition": ["1 id int32", "2 leader Node", "3 replicas Node*", "4 isr Node*"],
    "Node": ["1 id int32", "2 host string", "3 port int32", "4 rack string"],
    "Config": ["1 entries Entry*"],
    "Entry": ["1 name string", "2 value string"],
    "Empty": ["1 unset bool"],
}
SCALARS = {"int32": INT, "string": STRING, "bool": BOOL}

# Numbers of the entity types in a record.
ENTITY_NUMBERS = {CLUSTER: 0, BROKER: 1, TOPIC: 2}


def _fields(message: str) -> list[tuple[int, str, str, bool, bool]]:
    """Number, name, type, repeated and one-of member of each field."""
    lines = [line.split() for line in MESSAGES[message]]
    return [
        (int(number), name.lstrip("|"), kind.rstrip("*"), kind.endswith("*"), name.startswith("|"))
        for number, name, kind in lines
    ]


def message_type(message: str = "Event") -> StructType:
    """The struct type of a message."""
    types = {}
    for _, name, kind, repeated, _ in _fields(message):
        dtype = SCALARS.get(kind) or message_type(kind)
        types[name] = ArrayType(dtype) if repeated else dtype
    return struct(**types)


# Events and their messages


def _flags(event: Column, kind: str) -> dict[str, Column]:
    """For each operation of a kind, whether it is the event's."""
    return {op: event["op"] == op for op in OPERATIONS[kind]}


def to_message(event: Column) -> Column:
    """The message of an event."""
    cluster, broker, topic = (event[ARM[kind]] for kind in (CLUSTER, BROKER, TOPIC))

    def config(state: Column) -> Column:
        return F.struct(config_to_entries(state["config"]).alias("entries")).alias("config")

    values = {
        CLUSTER: F.struct(cluster["controller"].alias("controller")),
        BROKER: F.struct(broker["node"].alias("node"), config(broker)),
        TOPIC: F.struct(topic["description"].alias("description"), config(topic)),
    }
    empty = F.struct(F.lit(None).cast("boolean").alias("unset"))
    arms = []
    for kind, arm in ARM.items():
        state = event[arm]
        key = "name" if kind == TOPIC else "id"
        ops = [
            F.when(is_op, empty if kind == TOPIC and op != UPDATED else values[kind]).alias(op)
            for op, is_op in _flags(event, kind).items()
        ]
        arms.append(F.when(state.isNotNull(), F.struct(state[key].alias(key), *ops)).alias(arm))
    numbers = F.create_map(*[F.lit(x) for pair in ENTITY_NUMBERS.items() for x in pair])
    return F.struct(
        numbers[event["entity_type"]].alias("entity_type"), event["entity_id"].alias("entity_id"), *arms
    )


def from_message(message: Column) -> Column:
    """The event of a message: an empty rack is none, an absent config is empty."""

    def value(arm: str, part: str) -> Column:
        ops = (UPDATED,) if arm == "topic" else (CREATED, UPDATED)
        return F.coalesce(*[message[arm][op][part] for op in ops])

    def config(arm: str) -> Column:
        return config_from_entries(value(arm, "config")["entries"]).alias("config")

    states = {
        "cluster": F.struct(
            message["cluster"]["id"].alias("id"),
            canon(value("cluster", "controller"), NODE).alias("controller"),
        ),
        "broker": F.struct(
            message["broker"]["id"].alias("id"),
            canon(value("broker", "node"), NODE).alias("node"),
            config("broker"),
        ),
        "topic": F.struct(
            message["topic"]["name"].alias("name"),
            canon(value("topic", "description"), DESCRIPTION).alias("description"),
            F.when(message["topic"][UPDATED].isNotNull(), config("topic")).alias("config"),
        ),
    }
    ops = [
        F.when(message[arm][op].isNotNull(), op) for kind, arm in ARM.items() for op in OPERATIONS[kind]
    ]
    names = F.create_map(*[F.lit(x) for name, n in ENTITY_NUMBERS.items() for x in (n, name)])
    return F.struct(
        names[message["entity_type"]].alias("entity_type"),
        message["entity_id"].alias("entity_id"),
        F.coalesce(*ops).alias("op"),
        *[F.when(message[arm].isNotNull(), state).alias(arm) for arm, state in states.items()],
    )


# Messages and their bytes


def has_protobuf() -> bool:
    try:
        import google.protobuf  # noqa: F401
    except ImportError:
        return False
    return True


def _event_class():
    """The Protocol Buffers class of an event, made from MESSAGES."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    field = descriptor_pb2.FieldDescriptorProto
    scalars = {"int32": field.TYPE_INT32, "string": field.TYPE_STRING, "bool": field.TYPE_BOOL}
    file = descriptor_pb2.FileDescriptorProto(name="entitylog.proto", package="entitylog", syntax="proto3")
    for name in MESSAGES:
        message = file.message_type.add(name=name)
        for number, label, kind, repeated, member in _fields(name):
            added = message.field.add(name=label, number=number)
            added.label = field.LABEL_REPEATED if repeated else field.LABEL_OPTIONAL
            if kind in scalars:
                added.type = scalars[kind]
            else:
                added.type, added.type_name = field.TYPE_MESSAGE, f".entitylog.{kind}"
            if member:
                if not message.oneof_decl:
                    message.oneof_decl.add(name="value")
                added.oneof_index = 0
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("entitylog.Event"))


def _as_dict(message, name: str, fields: dict) -> dict:
    """A message as the row of its struct type; unset messages as null."""
    row = {}
    for field, kind, repeated in fields[name]:
        value = getattr(message, field)
        if kind in SCALARS:
            row[field] = value
        elif repeated:
            row[field] = [_as_dict(item, kind, fields) for item in value]
        elif message.HasField(field):
            row[field] = _as_dict(value, kind, fields)
    return row


def to_json(message: Column) -> Column:
    return F.encode(F.to_json(message), "UTF-8")


def from_json(value: Column) -> Column:
    return F.from_json(F.decode(value, "UTF-8"), message_type())


def to_protobuf(message: Column) -> Column:
    @F.arrow_udf("binary")
    def serialize(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cls = _event_class()
        for batch in batches:
            rows = (json.loads(text) for text in batch.to_pylist())
            yield pa.array([cls(**row).SerializeToString() for row in rows], pa.binary())

    # JSON crosses to Python faster than nested structs do.
    return serialize(F.to_json(message))


def from_protobuf(value: Column) -> Column:
    @F.arrow_udf("string")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cls = _event_class()
        fields = {m: [(f, kind, many) for _, f, kind, many, _ in _fields(m)] for m in MESSAGES}
        for batch in batches:
            messages = (cls.FromString(data) for data in batch.to_pylist())
            rows = (_as_dict(message, "Event", fields) for message in messages)
            yield pa.array([json.dumps(row) for row in rows], pa.string())

    return F.from_json(parse(value), message_type())


ENCODE = {"json": to_json, "protobuf": to_protobuf}
DECODE = {"json": from_json, "protobuf": from_protobuf}


def encode(events: DataFrame, format: str = "json", into: str = "value") -> DataFrame:
    """Events with their payload as bytes in one column."""
    event = F.struct(*[F.col(f.name) for f in PAYLOAD.fields])
    messages = events.withColumn("_message", to_message(event))
    return messages.withColumn(into, ENCODE[format](F.col("_message"))).drop("_message")


def decode(records: DataFrame, format: str = "json", value: str = "value") -> DataFrame:
    """Records with their payload as event columns, other columns kept.

    ``op_tag`` is not part of the payload; a decoded event has its own op there.
    """
    others = [c for c in records.columns if c not in (value, "key", "headers")]
    messages = records.withColumn("_message", DECODE[format](F.col(value)))
    events = messages.withColumn("_event", from_message(F.col("_message")))
    return events.select("_event.*", F.col("_event.op").alias("op_tag"), *others)
