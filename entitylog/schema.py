"""Canonical row shapes of snapshots, states and change-log events."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# Entity types and operations of the change log.
CLUSTER, BROKER, TOPIC = "CLUSTER", "BROKER", "TOPIC"
ENTITY_TYPES = (CLUSTER, BROKER, TOPIC)
CREATED, UPDATED, DELETED = "Created", "Updated", "Deleted"
OPERATIONS = {
    CLUSTER: (CREATED, UPDATED),
    BROKER: (CREATED, UPDATED),
    TOPIC: (CREATED, UPDATED, DELETED),
}

# Within one round a delete comes before a create, and a create before its
# first update.
SEQ = {DELETED: 0, CREATED: 1, UPDATED: 2}

DOUBLE = DoubleType()
STRING, INT, LONG, BOOL, BINARY = (
    StringType(),
    IntegerType(),
    LongType(),
    BooleanType(),
    BinaryType(),
)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


NODE = struct(id=INT, host=STRING, port=INT, rack=STRING)
PARTITION = struct(id=INT, leader=NODE, replicas=ArrayType(NODE), isr=ArrayType(NODE))
DESCRIPTION = struct(internal=BOOL, partitions=ArrayType(PARTITION))
CONFIG = MapType(STRING, STRING)

CLUSTER_STATE = struct(id=STRING, controller=NODE)
BROKER_STATE = struct(id=STRING, node=NODE, config=CONFIG)
TOPIC_STATE = struct(name=STRING, description=DESCRIPTION, config=CONFIG)

EVENT = struct(
    entity_type=STRING,
    entity_id=STRING,
    op=STRING,
    op_tag=STRING,
    cluster=CLUSTER_STATE,
    broker=BROKER_STATE,
    topic=TOPIC_STATE,
    round=LONG,
    seq=INT,
)

# What a record log stores: key and headers for routing, value for the payload.
RECORD = struct(
    key=STRING,
    value=BINARY,
    headers=ArrayType(struct(key=STRING, value=BINARY)),
    round=LONG,
    seq=INT,
)

# Tables of listed topics, and of lookups.
TOPICS, DESCRIPTIONS, CONFIGS = "TOPICS", "DESCRIPTIONS", "CONFIGS"

# Snapshot rows by kind. Topics and brokers have one row per key and round; a
# cluster listing may be spread over several rows, each with part of the nodes.
SNAPSHOT = {
    CLUSTER: struct(snapshot_id=LONG, id=STRING, controller=NODE, nodes=ArrayType(NODE)),
    BROKER: struct(snapshot_id=LONG, id=STRING, node=NODE, config=CONFIG, lookup_failed=BOOL),
    TOPIC: struct(
        snapshot_id=LONG, name=STRING, description=DESCRIPTION, config=CONFIG, lookup_failed=BOOL
    ),
    # What a poll lists and looks up by itself, before it is joined.
    TOPICS: struct(snapshot_id=LONG, name=STRING),
    DESCRIPTIONS: struct(snapshot_id=LONG, name=STRING, description=DESCRIPTION),
    CONFIGS: struct(
        snapshot_id=LONG, resource_type=STRING, name=STRING, config=CONFIG, lookup_failed=BOOL
    ),
}

ARM = {CLUSTER: "cluster", BROKER: "broker", TOPIC: "topic"}
STATE = {CLUSTER: CLUSTER_STATE, BROKER: BROKER_STATE, TOPIC: TOPIC_STATE}

# The cluster is one slot whatever its id, so its id is part of the value.
KEYS = {CLUSTER: [], BROKER: ["id"], TOPIC: ["name"]}
VALUES = {
    CLUSTER: ["id", "controller"],
    BROKER: ["node", "config"],
    TOPIC: ["description", "config"],
}
