"""Named queries of the core operators and, where SQL can state them, their equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgate import family_queries
from loomgate.operators import compact, drift, orphans, reconcile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": orphans.found,
    "p2_counts": orphans.counts,
    "p3_found": compact.found,
    "p3_manifest": compact.manifest,
    "p4_found": drift.found,
    "p4_table": drift.table,
    "p5_found": reconcile.found,
}

_P2_REFS = """
with refs as (
  select distinct 'original_id' ref_field, allocation_id record_id, cast(original_id as varchar) ref_key, recorded_at at_time, lower(table_name) table_key,
    case when lower(column_name) = 'contractsid' then 'c' else 'l' end || original_id pk
  from allocation_records where original_id is not null and lower(column_name) in ('contractsid', 'locationsid', 'parentlocationsid')
  union
  select 'new_sid', allocation_id, cast(new_sid as varchar), recorded_at, lower(table_name), case when lower(column_name) = 'contractsid' then 'tcontract' else 'tlocation' end || job_id || ':' || new_sid
  from allocation_records where new_sid is not null and lower(table_name) = 'tlocation' and lower(column_name) in ('contractsid', 'parentlocationsid')
  union
  select 'fk_columns_updated', result_id, fk, finished_at, lower(table_name), 'j' || 't' || regexp_replace(lower(trim(fk)), 'sid$', '') || ':' || job_id
  from (select *, unnest(fk_columns_updated) fk from transform_results) where fk is not null),
parents as (
  select 'c' || contractsid pk, loaded_at a, deleted_at b from tcontract
  union select 'l' || locationsid, loaded_at, deleted_at from tlocation
  union select lower(table_name) || job_id || ':' || new_sid, recorded_at, null from allocation_records
    where new_sid is not null and lower(column_name) = regexp_replace(lower(table_name), '^t', '') || 'sid'
  union select 'j' || lower(table_name) || ':' || job_id, finished_at, null from transform_results)
"""
_P2 = _P2_REFS + """,
judged as (
  select ref_field, record_id, ref_key, at_time, table_key, count(p.pk) n,
    coalesce(bool_or(p.a <= at_time and (p.b is null or p.b > at_time)), false) live, coalesce(bool_or(p.a <= at_time), false) came
  from refs r left join parents p using (pk) group by all),
orphans as (
  select ref_field, record_id, ref_key, at_time, table_key, case when n = 0 then 'missing' when not came then 'late' else 'deleted' end orphan_kind
  from judged where not live)
"""

_EXACT = "coalesce(cast(try_cast(payload ->> '$.{0}' as decimal(38, 12)) as varchar), payload ->> '$.{0}')"
_P3 = f"""
with files as (select file_id, bool_and(coalesce(commit_state = 'committed', false)) ok, min(lower(trim(target_table))) target from lake_files group by 1),
rows as (
  select r.file_id, r.row_no, r.payload, target, coalesce(ok, false) ok, row_number() over (
    partition by ok, target, row_key, payload ->> '$.label', {_EXACT.format("amount")}, {_EXACT.format("grade")}, payload ->> '$.as_of',
      payload ->> '$.note', json_type(payload, '$.label'), json_type(payload, '$.note'), json_type(payload, '$.as_of'), list_sort(json_keys(payload))
    order by r.file_id, r.row_no) k
  from lake_rows r left join files using (file_id))
"""

ORACLES: dict[str, str] = {
    "p2_found": _P2 + "select ref_field, record_id, ref_key, orphan_kind from orphans",
    "p2_counts": _P2_REFS + """,
bounds as (select epoch_us(min(at_time)) low, epoch_us(max(at_time)) high from refs),
r as (select refs.*, least(greatest(floor((epoch_us(coalesce(at_time, timestamp '9999-12-31')) - low) * 3 / (high - low + 1)), 0), 2) slice from refs, bounds),
p as (select pk, coalesce(a, timestamp '9999-12-31') a, case when b is not null then greatest(coalesce(a, timestamp '9999-12-31'), b) end b from parents),
e as (select p.*, least(greatest(floor((epoch_us(a) - low) * 3 / (high - low + 1)), 0), 2) a_slice, least(greatest(floor((epoch_us(b) - low) * 3 / (high - low + 1)), 0), 2) b_slice from p, bounds),
judged as (
  select batch, ref_field, record_id, ref_key, at_time, table_key, count(e.pk) n,
    coalesce(bool_or(e.a <= at_time and not coalesce(b_slice <= batch - 2 and e.b <= at_time, false)), false) live, coalesce(bool_or(e.a <= at_time), false) came
  from range(1, 5) g(batch) join r on r.slice <= batch - 1 left join e on e.pk = r.pk and a_slice <= batch - 2 group by all)
select cast(batch as integer) batch, table_key, strftime(at_time, '%Y-%m') period, ref_field, case when n = 0 then 'missing' when not came then 'late' else 'deleted' end orphan_kind, count(*) orphans
from judged where not live group by all""",
    "p3_found": _P3 + "select file_id, row_no from rows where not ok or k > 1",
    "p3_manifest": _P3 + """
select target, cast(ceil(sum(strlen(payload) + 24) / 1048576.0) as bigint) files, count(*) "rows", sum(strlen(payload)) payload_bytes
from rows where ok and k = 1 group by 1""",
    "p5_found": """
with a as (
  select run_id, regexp_replace(regexp_replace(lower(trim(table_name)), '[\\[\\]]', '', 'g'), '^.*\\.', '') table_key,
    arg_max({'r': rows_extracted, 'c': lower(trim(table_checksum))}, (finished_at, result_id)) v
  from table_results group by 1, 2),
p as (select run_id, arg_max({'r': map_entries(row_counts), 'c': map_entries(checksums)}, (checked_at, report_id)) v from validation_reports group by 1),
e as (
  select run_id, x.key k, x.value r, cast(null as varchar) c from (select run_id, unnest(v.r) x from p)
  union all select run_id, x.key, null, x.value from (select run_id, unnest(v.c) x from p)),
b as (select run_id, regexp_replace(regexp_replace(lower(trim(k)), '[\\[\\]]', '', 'g'), '^.*\\.', '') table_key, max(r) r, max(lower(trim(c))) c from e group by 1, 2)
select run_id, table_key, 'only_in_results' difference from a anti join b using (run_id, table_key)
union all select run_id, table_key, 'only_in_reports' from b anti join a using (run_id, table_key)
union all select run_id, table_key, 'rows' from a join b using (run_id, table_key) where a.v.r is distinct from b.r
union all select run_id, table_key, 'checksum' from a join b using (run_id, table_key) where a.v.c is distinct from b.c""",
}

QUERIES |= family_queries.QUERIES
ORACLES |= family_queries.ORACLES
