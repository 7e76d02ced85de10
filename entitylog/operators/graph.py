"""State as a graph: entities and the relations between them.

Entities are ``(entity_type, entity_id)``, relations ``(name, source,
destination)``. Everything works on flat rows: nested topic state is flattened
once and the lists in it are never gathered again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entities(df: DataFrame, entity_type: str, entity_id: Column) -> DataFrame:
    return df.select(
        F.lit(entity_type).alias("entity_type"), entity_id.cast("string").alias("entity_id")
    )


def _relations(df: DataFrame, name: str, source: Column, destination: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("name"),
        source.cast("string").alias("source"),
        destination.cast("string").alias("destination"),
    )


def union(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


# Flat rows from nested state.


def partition_rows(topics: DataFrame) -> DataFrame:
    """One row per partition: topic, partition_id, leader, replicas, isr."""
    return topics.select(
        F.col("name").alias("topic"), F.explode("description.partitions").alias("p")
    ).select(
        "topic", F.col("p.id").alias("partition_id"), "p.leader", "p.replicas", "p.isr"
    )


def replica_rows(partitions: DataFrame) -> DataFrame:
    """One row per replica: topic, partition_id, broker, leader, in_sync."""
    in_sync = F.exists("isr", lambda n: n["id"] == F.col("r.id"))
    return partitions.select("*", F.explode("replicas").alias("r")).select(
        "topic",
        "partition_id",
        F.col("r.id").alias("broker"),
        F.col("r.id").eqNullSafe(F.col("leader.id")).alias("leader"),
        F.coalesce(in_sync, F.lit(False)).alias("in_sync"),
    )


def isr_rows(partitions: DataFrame) -> DataFrame:
    """One row per member in sync, also of members that are no replicas."""
    return partitions.select("topic", "partition_id", F.explode("isr.id").alias("broker"))


# Ids.


def partition_id() -> Column:
    return F.concat_ws("-", "topic", "partition_id")


def replica_id() -> Column:
    return F.concat_ws("-", "topic", "partition_id", "broker")


# Entities. Each takes rows that are distinct already.


def topic_entities(topics: DataFrame, name: str = "name") -> DataFrame:
    return _entities(topics, "Topic", F.col(name))


def partition_entities(partitions: DataFrame) -> DataFrame:
    return _entities(partitions, "TopicPartition", partition_id())


def replica_entities(replicas: DataFrame) -> DataFrame:
    return _entities(replicas, "TopicPartitionReplica", replica_id())


def held_entities(replicas: DataFrame) -> DataFrame:
    """Topics, partitions and replicas of flat replica rows, in one pass."""
    ids = {
        "Topic": F.col("topic").cast("string"),
        "TopicPartition": partition_id(),
        "TopicPartitionReplica": replica_id(),
    }
    each = F.create_map(*[column for kind, id in ids.items() for column in (F.lit(kind), id)])
    return replicas.select(F.explode(each).alias("entity_type", "entity_id")).distinct()


def cluster_entities(cluster: DataFrame, id: str = "id") -> DataFrame:
    return _entities(cluster, "Cluster", F.col(id))


def broker_entities(brokers: DataFrame, id: str = "id") -> DataFrame:
    return _entities(brokers, "Broker", F.col(id))


def rack_entities(brokers: DataFrame, rack: str = "rack") -> DataFrame:
    """The racks brokers stand in; brokers without one add none."""
    named = brokers.filter(F.col(rack).isNotNull()).select(rack).distinct()
    return _entities(named, "Rack", F.col(rack))


def client_entities(clients: DataFrame, id: str = "id") -> DataFrame:
    return _entities(clients, "Client", F.col(id))


def schema_entities(schemas: DataFrame, subject: str = "subject") -> DataFrame:
    return _entities(schemas, "Schema", F.col(subject))


# Relations.


def topic_partitions(partitions: DataFrame) -> DataFrame:
    return _relations(partitions, "partitions", F.col("topic"), partition_id())


def partition_replicas(replicas: DataFrame) -> DataFrame:
    return _relations(replicas, "replicas", partition_id(), replica_id())


def partition_isr(members: DataFrame) -> DataFrame:
    return _relations(members, "isr", partition_id(), replica_id())


def replica_roles(replicas: DataFrame) -> DataFrame:
    """Who is in sync and who leads, of replica rows with both flags, in one pass."""
    roles = F.filter(
        F.array(F.when(F.col("in_sync"), "isr"), F.when(F.col("leader"), "leader")), lambda r: r.isNotNull()
    )
    found = replicas.withColumn("_role", F.explode(roles))
    return found.select(
        F.col("_role").alias("name"), partition_id().alias("source"), replica_id().alias("destination")
    )


def replica_brokers(replicas: DataFrame) -> DataFrame:
    return _relations(replicas, "broker", replica_id(), F.col("broker"))


def cluster_brokers(brokers: DataFrame, cluster: DataFrame) -> DataFrame:
    """The one cluster's brokers; none while there is no cluster."""
    id = cluster.select("id").scalar()
    edges = _relations(brokers, "brokers", id, F.col("id"))
    return edges.filter(F.col("source").isNotNull())


def member_brokers(brokers: DataFrame, group: str, id: str = "id") -> DataFrame:
    """Brokers by the group (a rack, a cluster) named in their row."""
    grouped = brokers.filter(F.col(group).isNotNull())
    return _relations(grouped, "brokers", F.col(group), F.col(id))


def client_topics(uses: DataFrame) -> DataFrame:
    """What clients do with topics: rows of client, topic and ``producing`` or ``consuming``."""
    return uses.select(
        F.col("role").alias("name"),
        F.col("client").cast("string").alias("source"),
        F.col("topic").cast("string").alias("destination"),
    )


def schema_users(uses: DataFrame) -> DataFrame:
    """Who uses a schema: rows of subject and user."""
    return _relations(uses, "usedBy", F.col("subject"), F.col("user"))


def from_state(
    topics: DataFrame,
    brokers: DataFrame,
    cluster: DataFrame,
    clients: DataFrame | None = None,
    client_uses: DataFrame | None = None,
    schemas: DataFrame | None = None,
    schema_uses: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Entities and relations of the current state.

    The tables are read several times, so give state that is stored, not state
    that is still to be folded. Clients and schemas are not part of the state;
    the caller brings them.
    """
    partitions = partition_rows(topics)
    replicas = replica_rows(partitions)
    racked = brokers.select("id", F.col("node.rack").alias("rack"))
    entities = [
        topic_entities(topics),
        partition_entities(partitions),
        replica_entities(replicas),
        cluster_entities(cluster),
        broker_entities(brokers),
        rack_entities(racked),
    ]
    relations = [
        topic_partitions(partitions),
        partition_replicas(replicas),
        partition_isr(isr_rows(partitions)),
        replica_brokers(replicas),
        cluster_brokers(brokers, cluster),
        member_brokers(racked, "rack"),
    ]
    if clients is not None:
        entities.append(client_entities(clients))
    if client_uses is not None:
        relations.append(client_topics(client_uses))
    if schemas is not None:
        entities.append(schema_entities(schemas))
    if schema_uses is not None:
        relations.append(schema_users(schema_uses))
    return union(*entities), union(*relations)


def with_metadata(entities: DataFrame, metadata: DataFrame) -> DataFrame:
    """Entities with their operational and organisational metadata maps.

    ``metadata`` has entity_type, entity_id, op_metadata and org_metadata; an
    entity without any gets empty maps.
    """
    empty = F.create_map().cast("map<string,string>")
    return entities.join(metadata, ["entity_type", "entity_id"], "left").withColumns(
        {name: F.coalesce(name, empty) for name in ("op_metadata", "org_metadata")}
    )
