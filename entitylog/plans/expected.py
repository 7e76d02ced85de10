"""What the queries in ``tables`` return, as plain SQL over the same tables."""

from __future__ import annotations

COMMON = """
with log as (
  select user_id as k, event_id as o, value, props, event_type,
    case event_type when 'signup' then 'Created' when 'error' then 'Deleted' else 'Updated' end as op,
    case user_id % 3 when 0 then 'CLUSTER' when 1 then 'BROKER' else 'TOPIC' end as entity_type
  from events),
valid_log as (select * from log where entity_type = 'TOPIC' or op <> 'Deleted'),
dated as (select *, cast((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) - 1 as bigint) as q from orders),
cut as (select (min(q) + max(q)) // 2 as middle from dated),
prev as (select o_custkey as k, count(*) as n, max(o_orderpriority) as p from dated
  where q < (select middle from cut) group by 1),
cur as (select o_custkey as k, count(*) as n, max(o_orderpriority) as p from dated
  where q >= (select middle from cut) group by 1),
ordered as (select o_custkey as k, count(*) as n, max(o_orderpriority) as p from orders group by 1),
broker_all as (select s_suppkey as id, s_name as host, s_nationkey as port,
    case when s_suppkey % 5 = 0 then null else n_name end as rack,
    cast(floor(s_acctbal / 1000) as bigint) as tier, n_regionkey as region
  from supplier join nation on s_nationkey = n_nationkey),
broker_prev as (select * from broker_all where tier <> 0),
broker_cur as (select id, case when port = 7 then host || '-moved' else host end as host, port, rack, tier
  from broker_all where tier <> 1),
part_rows as (select l_orderkey as topic, l_linenumber as partition_id, min(l_suppkey) as leader,
    array_to_string(list_sort(list(distinct l_suppkey)), ',') as replicas
  from lineitem group by 1, 2),
replica_rows as (select distinct l_orderkey as topic, l_linenumber as partition_id, l_suppkey as broker from lineitem),
snap as (select o_custkey as k, cast((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) - 1 as bigint) as r,
    count(*) as n, max(o_orderpriority) as p
  from orders group by 1, 2),
controllers as (select r, 'cluster-' || cast(r // 8 as varchar) as id, controller from (
    select cast((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) - 1 as bigint) as r, o_custkey as controller,
      row_number() over (partition by year(o_orderdate), quarter(o_orderdate) order by o_totalprice desc, o_orderkey desc) as rn
    from orders) t where rn = 1),
topics_now as (select * from (select *, row_number() over (partition by k order by o desc) as rn
    from log where entity_type = 'TOPIC' and op <> 'Created') t where rn = 1 and op = 'Updated'),
brokers_now as (select * from (select *, row_number() over (partition by k order by o desc) as rn
    from log where entity_type = 'BROKER' and op <> 'Deleted') t where rn = 1),
cluster_now as (select * from log where entity_type = 'CLUSTER' and op <> 'Deleted' order by o desc limit 1)
"""

CODEC = """
select o, entity_type, cast(k as varchar) as entity_id, op,
  case when entity_type <> 'TOPIC' or op = 'Updated' then 'host-' || cast(o % 10 as varchar) end as host,
  case when (entity_type <> 'TOPIC' or op = 'Updated') and o % 3 <> 0 then 'rack-' || cast(o % 3 as varchar) end as rack,
  case when entity_type = 'BROKER' or (entity_type = 'TOPIC' and op = 'Updated')
    then json_extract_string(props, '$.k') end as config_k,
  case when entity_type = 'TOPIC' and op = 'Updated' then event_type = 'view' end as internal,
  case when entity_type = 'TOPIC' and op = 'Updated' then cast(o % 7 as integer) end as partition_id,
  case when entity_type = 'TOPIC' and op = 'Updated' then 1 end as n_partitions
from valid_log
"""

TOPICS = """
select cast(k as varchar) as name, event_type = 'view' as internal,
  'host-' || cast(o % 10 as varchar) as leader_host, json_extract_string(props, '$.k') as config_k
from topics_now
"""

MULTI_ROUND = """
select k, r, case when lr is null or lr < r - 1 then 'Created' else 'Updated' end as op
from (select *, lag(r) over w as lr, lag(n) over w as ln, lag(p) over w as lp
      from snap window w as (partition by k order by r)) t
where lr is null or lr < r - 1 or n is distinct from ln or p is distinct from lp
union all
select k, r + 1, 'Deleted' from (select *, lead(r) over (partition by k order by r) as nr from snap) t
where (nr is null or nr > r + 1) and r < (select max(r) from snap)
"""

STEPS = f"""
, changes as ({MULTI_ROUND})
select c.k, c.r, s.seq, s.op, c.op as op_tag, case when s.seq = 2 then snap.n end as n
from changes c join (values ('Deleted', 0, 'Deleted'), ('Created', 1, 'Created'), ('Created', 2, 'Updated'),
    ('Updated', 2, 'Updated')) s(change, seq, op) on c.op = s.change
  left join snap on snap.k = c.k and snap.r = c.r
"""

# Where the last of four equal parts of the quarters begins.
LAST_PART = "(select min(r) + (max(r) - min(r) + 1) * 3 // 4 from snap)"

LISTED = """
, listed as (select l_suppkey as id, cast((year(l_shipdate) - 1992) * 4 + quarter(l_shipdate) as bigint) as r,
    count(*) as port, max(l_linestatus) as node from lineitem group by 1, 2)
"""

STATEMENTS = {
    "stream_snapshots_to_log": STEPS,
    "poll_state_versions": f"""
select 'last' as version, k, n from snap where r = (select max(r) from snap)
union all select 'before', k, n from snap where r = {LAST_PART} - 1
""",
    "poll_log_version": f"select * from ({STEPS.replace(', changes as', 'with changes as', 1)}) t where r < {LAST_PART}",
    "chunked_descriptions": """
select topic, partition_id // 500 as chunk, count(*) as n_partitions,
  string_agg(partition_id || ':' || leader, ';' order by partition_id) as partitions
from (select l_suppkey as topic, l_orderkey as partition_id, cast(max(l_quantity) as int) as leader from lineitem group by 1, 2) t
group by 1, 2
""",
    "digest_changelog": f"""
, found as ({MULTI_ROUND})
select f.k, f.r, f.op, snap.n, snap.p from found f left join snap on f.op <> 'Deleted' and f.k = snap.k and f.r = snap.r
""",
    "environment_lists": """
select c_custkey, n_name, '90000000 microseconds' as interval from customer join nation on c_nationkey = n_nationkey
where n_name in ('NATION_10', 'NATION_3', 'NATION_9') and c_mktsegment <> 'MACHINERY'
""",
    "followed_counters": """
select entity_type, op, cast(count(*) as double) as total from valid_log group by 1, 2
""",
    "listed_brokers": LISTED + """
, spoken as (select id, r, port, case when id % 7 <> 0 then node end as mode, row_number() over w as n,
    lag(port) over w as last_port, lag(case when id % 7 <> 0 then node end) over w as last_mode
  from listed where id % 7 = 0 or id % 11 <> 3 window w as (partition by id order by r))
select id, r, case when n = 1 then 'Created' else 'Updated' end as op, port, mode from spoken
where n = 1 or port <> last_port or mode is distinct from last_mode
""",
    "missing_broker_rounds": """
, near as (select *, lead(r) over w as following, lag(p) over w as last_p, lag(r) over w as last_r
  from snap window w as (partition by k order by r)),
moved as (select k, r, r - row_number() over (partition by k order by r) as island from near
  where last_r is not null and p is distinct from last_p)
select k, r + 1 as first, coalesce(following, (select max(r) + 1 from snap)) - 1 as last, false as moved from near
where coalesce(following, (select max(r) + 1 from snap)) > r + 1
union all select k, min(r), max(r), true from moved group by k, island
""",
    "topics_current": """
select k, o, value from (select *, row_number() over (partition by k order by o desc) as rn
  from log where op <> 'Created') t where rn = 1 and op = 'Updated'
""",
    "brokers_current": """
select k, o, value from (select *, row_number() over (partition by k order by o desc) as rn
  from log where op <> 'Deleted') t where rn = 1
""",
    "cluster_current": """
select k, o, value from log where op <> 'Deleted' order by o desc limit 1
""",
    "consumed_counters": """
select entity_type, op, cast(count(*) as double) as total from log group by 1, 2
""",
    "canonical_topics": TOPICS,
    "canonical_brokers": """
select cast(k as varchar) as id, 'host-' || cast(o % 10 as varchar) as host,
  case when o % 3 <> 0 then 'rack-' || cast(o % 3 as varchar) end as rack,
  json_extract_string(props, '$.k') as config_k
from brokers_now
""",
    "canonical_cluster": """
select cast(k as varchar) as id, 'host-' || cast(o % 10 as varchar) as controller_host from cluster_now
""",
    "diff_created": """
select k, n, p from cur where not exists (select 1 from prev where prev.k = cur.k)
""",
    "diff_deleted": """
select k from prev where not exists (select 1 from cur where prev.k = cur.k)
""",
    "diff_known": """
select k from cur where exists (select 1 from prev where prev.k = cur.k)
""",
    "diff_updated": """
select cur.k, cur.n, cur.p from cur join prev on cur.k = prev.k
where cur.n is distinct from prev.n or cur.p is distinct from prev.p
""",
    "topic_changelog": """
select k, 0 as seq, 'Deleted' as op from prev where not exists (select 1 from cur where cur.k = prev.k)
union all select k, 1, 'Created' from cur where not exists (select 1 from prev where prev.k = cur.k)
union all select k, 2, 'Updated' from cur where not exists (select 1 from prev where prev.k = cur.k)
union all select cur.k, 2, 'Updated' from cur join prev on cur.k = prev.k
  where cur.n is distinct from prev.n or cur.p is distinct from prev.p
""",
    "topic_changelog_filtered": """
select k, 0 as seq, 'Deleted' as op from prev where not exists (select 1 from cur where cur.k = prev.k)
union all select k, s, case s when 1 then 'Created' else 'Updated' end
  from cur, (values (1), (2)) steps(s)
  where p in ('1-URGENT', '5-LOW') and not exists (select 1 from prev where prev.k = cur.k)
union all select cur.k, 2, 'Updated' from cur join prev on cur.k = prev.k
  where cur.p in ('1-URGENT', '5-LOW') and (cur.n is distinct from prev.n or cur.p is distinct from prev.p)
""",
    "produced_counters": """
select entity_type, op_tag, cast(count(*) as double) as total from (
  select 'TOPIC' as entity_type, 'Created' as op_tag from cur where k not in (select k from prev)
  union all select 'TOPIC', 'Created' from cur where k not in (select k from prev)
  union all select 'TOPIC', 'Updated' from cur join prev using (k) where cur.n <> prev.n or cur.p <> prev.p
  union all select 'TOPIC', 'Deleted' from prev where k not in (select k from cur)
  union all select 'BROKER', case when p.id is null then 'Created' else 'Updated' end
    from broker_cur c left join broker_prev p on c.id = p.id
    where p.id is null or c.host is distinct from p.host or c.port is distinct from p.port
      or c.rack is distinct from p.rack or c.tier is distinct from p.tier
  union all select 'CLUSTER', case when b.id is null then 'Created' else 'Updated' end
    from controllers a left join controllers b on b.r = a.r - 1
    where a.r = (select max(r) from controllers)
      and (a.id is distinct from b.id or a.controller is distinct from b.controller)) t group by 1, 2
""",
    "broker_diff": """
select cast(c.id as varchar) as id, case when p.id is null then 'Created' else 'Updated' end as op, c.host
from broker_cur c left join broker_prev p on c.id = p.id
where p.id is null or c.host is distinct from p.host or c.port is distinct from p.port
   or c.rack is distinct from p.rack or c.tier is distinct from p.tier
""",
    "missing_brokers": """
select p.id, p.host from broker_prev p where not exists (select 1 from broker_cur c
  where c.id = p.id and c.host = p.host and c.port = p.port and c.rack is not distinct from p.rack)
""",
    "cluster_diff": """
select case when b.id is null then 'Created' else 'Updated' end as op, a.id, a.controller
from controllers a left join controllers b on b.r = a.r - 1
where a.r = (select max(r) from controllers)
  and (a.id is distinct from b.id or a.controller is distinct from b.controller)
""",
    "failed_lookups": """
select c_custkey, case when c_acctbal >= 5000 then 'Updated' else 'Created' end as op, coalesce(p, '') as p
from customer left join ordered on c_custkey = k
where coalesce(n, 0) % 2 = 0 and (c_acctbal < 5000 or p is not null)
""",
    "multi_round_changelog": MULTI_ROUND,
    "multi_round_chunked": MULTI_ROUND,
    "multi_round_filtered": """
, runs as (select *, sum(case when lr is null or lr < r - 1 then 1 else 0 end) over (partition by k order by r) as run
  from (select *, lag(r) over (partition by k order by r) as lr from snap) t),
spoken as (select *, lag(n) over w as ln, lag(p) over w as lp, row_number() over w as rn
  from runs where p <> '5-LOW' window w as (partition by k, run order by r))
select k, r, case when rn = 1 then 'Created' else 'Updated' end as op
from spoken where rn = 1 or n is distinct from ln or p is distinct from lp
union all
select k, max(r) + 1, 'Deleted' from runs group by k, run
having max(r) < (select max(r) from snap) and count(*) filter (where p <> '5-LOW') > 0
""",
    "broker_changelog": """
select k, r, case when lr is null then 'Created' else 'Updated' end as op, n
from (select *, lag(r) over w as lr, lag(n) over w as ln, lag(p) over w as lp
      from snap window w as (partition by k order by r)) t
where lr is null or n is distinct from ln or p is distinct from lp
""",
    "cluster_changelog": """
select r, case when lr is null then 'Created' else 'Updated' end as op, id, controller
from (select *, lag(r) over (order by r) as lr, lag(id) over (order by r) as lid,
        lag(controller) over (order by r) as lc from controllers) t
where lr is null or id is distinct from lid or controller is distinct from lc
""",
    "replayed_state": """
select k, n, p from snap where r = (select max(r) from snap)
""",
    "dated_rounds": """
, days as (select d, row_number() over (order by d) - 1 as no
  from (select distinct cast(o_orderdate as date) as d from orders) t),
daily as (select o_orderpriority as k, no as r, count(*) as n
  from orders join days on cast(o_orderdate as date) = d group by 1, 2),
changes as (
  select k, r, case when lr is null or lr < r - 1 then 'Created' else 'Updated' end as op
  from (select *, lag(r) over w as lr, lag(n) over w as ln from daily window w as (partition by k order by r)) t
  where lr is null or lr < r - 1 or n is distinct from ln
  union all
  select k, r + 1, 'Deleted' from (select *, lead(r) over (partition by k order by r) as nr from daily) t
  where (nr is null or nr > r + 1) and r < (select max(r) from daily))
select k, r as round_no, op from changes
""",
    "snapshot_sizes": """
select r, count(*) as n_keys from snap group by 1
""",
    "stored_snapshots": """
select k, r, n, p from snap
""",
    "allow_deny": """
select c_custkey, c_mktsegment from customer
where c_mktsegment not in ('FURNITURE') and c_mktsegment in ('FURNITURE', 'BUILDING', 'MACHINERY')
""",
    "allow_deny_tables": """
select c_custkey, c_nationkey from customer
where c_custkey in (select o_custkey from orders)
  and c_nationkey not in (select n_nationkey from nation where n_regionkey = 1)
""",
    "csv_lists": """
select doc_id, cast(len(names) as bigint) as n_names, names[len(names)] as last_name
from (select doc_id, list_filter(string_split(text, ','), lambda x: x <> '') as names from documents) t
""",
    "include_internal": """
select o_orderkey from orders where not (o_orderpriority = '5-LOW')
""",
    "topic_names": """
select distinct l_orderkey from lineitem
""",
    "brokers_of": """
select cast(region as bigint) as snapshot_id, cast(id as varchar) as id, host, rack from broker_all
union all
select cast(region as bigint), cast(id + 1000000 as varchar), host, rack from broker_all
""",
    "config_enrich": """
select c_custkey, coalesce(t.p, '') as priority from customer left join ordered t on c_custkey = t.k
""",
    "resource_configs": """
select c_custkey, config_k from customer left join (
  select k, json_extract_string(props, '$.k') as config_k,
    row_number() over (partition by k order by o desc) as rn
  from log where entity_type = 'TOPIC') t on c_custkey = k and rn = 1
""",
    "config_map": """
select o, json_extract_string(props, '$.k') as config_k from log
""",
    "config_last_wins": """
select k, event_type as name, value from (
  select *, row_number() over (partition by k, event_type order by o desc) as rn from log) t where rn = 1
""",
    "topic_descriptions": """
select topic, count(*) as n_partitions,
  string_agg(cast(partition_id as varchar) || ':' || cast(leader as varchar) || ':' || replicas, ';' order by partition_id) as partitions
from part_rows group by 1
""",
    "described_topics": """
select o_orderkey as name, o_orderpriority, n_partitions
from orders join (select topic, count(*) as n_partitions from part_rows group by 1) t on o_orderkey = topic
""",
    "envelope_keys": """
select entity_type || '-' || cast(k as varchar) as record_key, o from log
""",
    "route_topics": """
select k, o, op from log where entity_type = 'TOPIC'
""",
    "merged_kinds": """
select entity_type as kind, op, o, cast(k as varchar) as id from log
""",
    "quarantine": """
, seen as (select o, case when o % 13 = 0 then 'CLUSTER' else entity_type end as label,
    case when o % 11 = 0 then 'no payload'
      when entity_type <> 'TOPIC' and op = 'Deleted' then 'no such operation' end as problem,
    o % 13 = 0 and entity_type <> 'CLUSTER' as mislabelled from log)
select 'valid' as problem, label as entity_type, o from seen where problem is null
union all select coalesce(problem, 'entity type differs'), label, o from seen
  where problem is not null or mislabelled
""",
    "codec_json": CODEC,
    "codec_protobuf": CODEC,
    "record_log": CODEC,
    "record_keys": """
select entity_type || '-' || cast(k as varchar) as key, entity_type as header, count(*) as n, max(o) as last
from valid_log group by 1, 2
""",
    "table_log": CODEC,
    "stored_topics": TOPICS,
    "sql_events": """
select o, cast(k as varchar) as entity_id, op, cast(k as varchar) as id,
  case when entity_type = 'CLUSTER' then 'host-' || cast(o % 10 as varchar) end as host
from log where (entity_type = 'TOPIC' and op = 'Created') or (entity_type = 'CLUSTER' and op = 'Updated')
""",
    "described_created": """
select cast(log.k as varchar) as name, log.o, 'Updated' as op, 'Created' as op_tag, 2 as seq,
  json_extract_string(t.props, '$.k') as config_k
from log join topics_now t on log.k = t.k where log.entity_type = 'TOPIC' and log.op = 'Created'
""",
    "json_topics": TOPICS,
    "sql_views": """
select json_extract_string(props, '$.k') as config_k, count(*) as n_topics,
  count(*) filter (where event_type = 'view') as n_internal
from topics_now group by 1
""",
    "graph_entities": """
select distinct 'Topic' as entity_type, cast(topic as varchar) as entity_id from part_rows
  union all select 'TopicPartition', cast(topic as varchar) || '-' || cast(partition_id as varchar) from part_rows
  union all select 'TopicPartitionReplica', cast(topic as varchar) || '-' || cast(partition_id as varchar) || '-' || cast(broker as varchar) from replica_rows
  union all select 'Broker', cast(id as varchar) from broker_all
  union all select distinct 'Rack', rack from broker_all where rack is not null
""",
    "graph_relations": """
select 'replicas' as name, cast(topic as varchar) || '-' || cast(partition_id as varchar) as source,
  cast(topic as varchar) || '-' || cast(partition_id as varchar) || '-' || cast(broker as varchar) as destination
from replica_rows
""",
    "graph_partitions": """
select 'partitions' as name, cast(topic as varchar) as source,
  cast(topic as varchar) || '-' || cast(partition_id as varchar) as destination
from part_rows
""",
    "graph_replica_brokers": """
select 'broker' as name,
  cast(topic as varchar) || '-' || cast(partition_id as varchar) || '-' || cast(broker as varchar) as source,
  cast(broker as varchar) as destination
from replica_rows
""",
    "graph_isr": """
, flags as (select l_orderkey as topic, l_linenumber as partition_id, l_suppkey as broker,
    max(case when l_linestatus = 'O' then 1 else 0 end) as in_sync
  from lineitem group by 1, 2, 3),
ids as (select *, cast(topic as varchar) || '-' || cast(partition_id as varchar) as source,
    cast(topic as varchar) || '-' || cast(partition_id as varchar) || '-' || cast(broker as varchar) as destination,
    min(broker) over (partition by topic, partition_id) as leader
  from flags)
select 'isr' as name, source, destination from ids where in_sync = 1
union all
select 'leader', source, destination from ids where broker = leader
""",
    "graph_from_state": """
, held as (select cast(k as varchar) as topic, cast(o % 7 as varchar) as part, cast(o % 10 as varchar) as broker from topics_now),
ids as (select topic, topic || '-' || part as part, topic || '-' || part || '-' || broker as replica, broker from held)
select 'entity' as what, 'Topic' as name, topic as source, cast(null as varchar) as destination from ids
union all select 'entity', 'TopicPartition', part, null from ids
union all select 'entity', 'TopicPartitionReplica', replica, null from ids
union all select 'entity', 'Broker', cast(k as varchar), null from brokers_now
union all select 'entity', 'Cluster', cast(k as varchar), null from cluster_now
union all select distinct 'entity', 'Rack', 'rack-' || cast(o % 3 as varchar), null from brokers_now where o % 3 <> 0
union all select 'relation', 'partitions', topic, part from ids
union all select 'relation', 'replicas', part, replica from ids
union all select 'relation', 'isr', part, replica from ids
union all select 'relation', 'broker', replica, broker from ids
union all select 'relation', 'brokers', cast(c.k as varchar), cast(b.k as varchar) from cluster_now c, brokers_now b
union all select 'relation', 'brokers', 'rack-' || cast(o % 3 as varchar), cast(k as varchar) from brokers_now where o % 3 <> 0
""",
    "rack_brokers": """
select 'brokers' as name, rack as source, cast(id as varchar) as destination from broker_all where rack is not null
""",
    "cluster_brokers": """
select 'brokers' as name, r_name as source, cast(s_suppkey as varchar) as destination
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "graph_clients": """
select 'producing' as name, cast(o_custkey as varchar) as source, cast(o_orderkey as varchar) as destination from orders
union all
select distinct 'consuming', cast(l_suppkey as varchar), cast(l_orderkey as varchar)
from lineitem
""",
    "graph_schemas": """
select distinct 'usedBy' as name, p_brand as source, cast(l_suppkey as varchar) as destination
from lineitem join part on l_partkey = p_partkey
""",
    "graph_metadata": """
select 'Broker' as entity_type, cast(id as varchar) as entity_id,
  case when tier >= 5 then cast(tier as varchar) end as tier, case when tier >= 5 then host end as host
from broker_all
""",
}

# What is written and read back, and a stream that has read everything, give
# what the batch query gives.
SAME_AS = {
    "stored_counters": "consumed_counters",
    "stored_json": "canonical_brokers",
    "stream_topics": "topics_current",
    "stream_brokers": "brokers_current",
    "stream_cluster": "cluster_current",
    "stream_counters": "consumed_counters",
    "kept_graph": "graph_from_state",
    "poll_restarted": "stream_snapshots_to_log",
    "served_topics": "topics_current",
    "served_brokers": "brokers_current",
    "served_cluster": "cluster_current",
}


def sql() -> dict[str, str]:
    statements = {**STATEMENTS, **{name: STATEMENTS[same] for name, same in SAME_AS.items()}}
    return {name: COMMON + text for name, text in statements.items()}
