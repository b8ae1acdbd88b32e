"""SQL for the core's queries, in DuckDB's dialect; what SQL cannot state is tested in tests/ instead."""

_KEY = "case when coalesce({0},'')='' then {1} else {0}||':'||{1} end"
_LEVEL = r"case when upper({0})='DISABLED' then 'NONE' else regexp_replace(upper({0}),'_ALL$','_TRANSITIVE') end"

_P1 = rf"""
with m as (
  select distinct {_KEY.format("target_context", "target_subject")} k, source_registry||':'||source_schema_name sk
  from mappings where status in ('ready','warning')),
g as (
  select registry_name||':'||name sk, arg_max({_LEVEL.format("compatibility")}, updated_time) compat, arg_max(upper(data_format), updated_time) fmt
  from glue_schemas group by 1),
l as (select key sk, arg_max(versions, completed_at) n from completed group by 1),
s as (select distinct {_KEY.format("context", "name")} k, {_LEVEL.format("compatibility")} compat, upper(schema_type) fmt, versions from subjects),
b as (
  select m.k, m.sk, g.compat gc, g.fmt gf, s.compat sc, s.fmt sf, len(s.versions) n, l.n ln, l.sk lk
  from m join s on m.k=s.k left join g on g.sk=m.sk left join l on l.sk=m.sk),
gv as (
  select b.k, v.version_number vn, md5(regexp_replace(arg_max({{d: v.definition}}, v.ingested_at).d,'\s+','','g')) h
  from b join glue_versions v on v.registry_name||':'||v.schema_name=b.sk where v.status='AVAILABLE' group by 1,2),
sv as (
  select k, v.version::bigint vn, md5(regexp_replace(v.schema,'\s+','','g')) h
  from (select s.k, unnest(s.versions) v from s semi join b on s.k=b.k)),
found as (
  select k target_key, 'subject' field from m anti join s on m.k=s.k
  union select k, 'source' from s anti join m on m.k=s.k
  union select k, 'completed' from b where lk is null
  union select k, 'compatibility' from b where gc is distinct from sc
  union select k, 'schema_type' from b where gf is distinct from sf
  union select k, 'completed_versions' from b where lk is not null and ln is distinct from n
  union select coalesce(gv.k,sv.k), 'versions' from gv full join sv on gv.k=sv.k and gv.vn=sv.vn where gv.k is null or sv.k is null
  union select gv.k, 'schema' from gv join sv on gv.k=sv.k and gv.vn=sv.vn where gv.h is distinct from sv.h)
"""

_NODES = """
p as (
  select registry_name, name, registry_name||':'||name k, arg_max({r: "references"}, parsed_at).r refs, max(parsed_at) seen_at
  from parsed_schemas group by 1,2,3),
"""

_P4 = f"""
with recursive {_NODES}
r as (select k, registry_name, unnest(refs) ref, unnest(range(len(refs))) pos from p where len(refs)>0),
byname as (select name, min(k) k from p group by 1),
t as (
  select r.k, r.pos, case when a.k is not null then a.k when o.k is not null then o.k else n.k end target
  from r left join p a on a.k=r.ref left join p o on o.k=r.registry_name||':'||r.ref left join byname n on n.name=r.ref),
link as (select k, arg_min(target, pos) parent from t where target is not null and target<>k group by 1),
walk(k, here, steps, seen, loop) as (
  select k, parent, 1, [k, parent], false from link
  union all
  select w.k, l.parent, w.steps+1, list_append(w.seen, l.parent), list_contains(w.seen, l.parent)
  from walk w join link l on l.k=w.here where not w.loop),
last as (select k, arg_max(here, steps) here, max(steps) depth, bool_or(loop) loop, arg_max(seen, steps) seen from walk group by 1),
found as (
  select k schema_key,
         case when loop then list_min(seen[list_position(seen, here):]) else here end root_key,
         case when loop then -1 else depth end::bigint depth
  from last)
"""

_P5 = f"""
with {_NODES}
g as (select registry_name||':'||name k, registry_name, name, arg_max(created_time, updated_time) born from glue_schemas group by 1,2,3),
byname as (select name, min(k) k from g group by 1),
gone as (select registry_name||':'||schema_name k, bool_and(status='DELETING') gone from glue_versions group by 1),
r as (select distinct k src, registry_name, unnest(refs) ref, seen_at from p),
t as (
  select r.*, case when a.k is not null then a.k when o.k is not null then o.k else n.k end target
  from r left join g a on a.k=r.ref left join g o on o.k=r.registry_name||':'||r.ref left join byname n on n.name=r.ref
  where r.ref<>''),
a as (
  select 'parsed_schemas' src_table, t.src src_key, t.ref, t.seen_at,
         case when t.target is null then 'missing' when coalesce(gone.gone,false) then 'deleted' when g.born>t.seen_at then 'late' end reason
  from t left join gone on gone.k=t.target left join g on g.k=t.target),
q as (
  select distinct request_id, context, requested_at, unnest("references").subject ref from requests),
q2 as (
  select *, case when contains(ref,':') then ref when coalesce(context,'')='' then ref else context||':'||ref end k from q where ref<>''),
s as (select {_KEY.format("context", "name")} k, max(len(versions)) n from subjects group by 1),
f as (select {_KEY.format("context", "subject")} k, min(requested_at) born from requests group by 1),
b as (
  select 'requests' src_table, request_id src_key, ref, requested_at seen_at,
         case when s.k is null then 'missing' when s.n=0 then 'deleted' when f.born>requested_at then 'late' end reason
  from q2 left join s on s.k=q2.k left join f on f.k=q2.k),
found as (select distinct src_table, src_key, ref, reason, seen_at from (select * from a union all by name select * from b) where reason is not null)
"""

_WALKED = _P4 + """,
loops as (select k from last where loop),
below as (select here as key, k descendant, steps::bigint steps from walk where k not in (select k from loops)),
sizes as (select key, count(*) n from below group by 1),
stated as (select source_registry||':'||source_schema_name key, min(dependency_level) stated_level from mappings group by 1),
tree as (
  select p.k as key, link.parent, coalesce(f.root_key, p.k) root_key, coalesce(f.depth, 0) depth,
         case when f.depth=-1 then null when f.depth is null then p.k else array_to_string(list_reverse(last.seen), ' > ') end path,
         case when coalesce(f.depth, 0)>=0 then 1+coalesce(s.n, 0) end as size, coalesce(f.depth=-1, false) is_cyclic
  from p left join link on link.k=p.k left join found f on f.schema_key=p.k left join last on last.k=p.k left join sizes s on s.key=p.k)
"""

# Walks each definition from its objects and arrays down: a member of `properties`, or an element of `fields`, is a field.
_P2 = r"""
with recursive d as (
  select distinct schema_version_id id, definition::json j, regexp_matches(definition, '"fields"\s*:\s*\[\s*\{') avro
  from glue_versions where json_valid(definition) and regexp_matches(definition, '^\s*\{')),
n(id, avro, j, ctx, path, depth, is_field) as (
  select id, avro, j, '', '', 0, false from d
  union all
  select id, avro, v, ctx2,
         case when is_new then case when path='' then name else path||'.'||name end
              else path||case when ctx2 in ('items','prefixItems') then '[]' when ctx2 in ('values','additionalProperties') then '{}' else '' end end,
         depth + is_new::int, is_new
  from (
    select id, avro, path, depth, e.k, e.v v,
           (ctx='properties' and not avro) or (ctx='fields' and avro and json_type(j)='ARRAY') is_new,
           case when ctx='properties' and not avro then e.k else e.v->>'$.name' end as name,
           case when ctx in ('properties','patternProperties','definitions','$defs','fields') and e.k is not null or json_type(j)='ARRAY' then '' else e.k end ctx2,
           ctx
    from (
      select id, avro, j, ctx, path, depth,
             unnest(case json_type(j) when 'OBJECT' then list_transform(map_entries(json_transform(j, '"MAP(VARCHAR,JSON)"')), lambda x: {'k': x.key, 'v': x.value})
                                      when 'ARRAY' then list_transform(json_extract(j, '$[*]'), lambda x: {'k': '', 'v': x}) end) e
      from n where json_type(j) in ('OBJECT','ARRAY')))
  where (is_new and name is not null) or (not is_new and json_type(v) in ('OBJECT','ARRAY')
    and not list_contains(['default','doc','description','symbols','enum','const','examples','aliases','required'], ctx2)))
"""

SQL = {
    "p1_found": _P1 + "select * from found",
    "p1_by_field": _P1 + "select field, count(*) n_targets from found group by 1",
    "p1_presence": _P1 + ", e as (select distinct k from m), t as (select distinct k from s) select (select count(*) from (select k from e union select k from t)) n_keys, (select count(*) from e where k not in (select k from t)) only_expected, (select count(*) from t where k not in (select k from e)) only_stored, (select count(*) from e where k in (select k from t)) as both",
    "p2_found": _P2 + "select distinct id schema_version_id, path field_path from n where is_field and depth>=3",
    "p2_top_level": """with d as (select distinct schema_version_id id, definition::json j from glue_versions where json_valid(definition) and regexp_matches(definition, '^\\s*\\{')), f as (select id, unnest(json_extract(j,'$.fields[*]')) x, unnest(range(len(json_extract(j,'$.fields[*]'))))::int ordinal from d)
select id, ordinal, x->>'$.name' as name, case when json_type(x,'$.type')='VARCHAR' then x->>'$.type' end as type, x->>'$.doc' doc from f where x->>'$.name' is not null""",
    "p2_unparsed": """with s as (select registry_name, name, arg_max(data_format, updated_time) data_format from glue_schemas group by 1,2), v as (select distinct registry_name, schema_name, schema_version_id, definition from glue_versions)
select v.registry_name, data_format, case when definition is null then 'null' when trim(definition)='' then 'empty' else 'damaged' end state, count(*) n_versions from v left join s on s.registry_name=v.registry_name and s.name=v.schema_name
where definition is null or trim(definition)='' or (data_format in ('AVRO','JSON') and not (json_valid(definition) and regexp_matches(definition,'^\\s*[{\\[]'))) group by all""",
    "p4_found": _P4 + "select * from found",
    "p4_descendants": _WALKED + "select * from below",
    "p4_hierarchy": _WALKED + "select tree.*, stated_level, stated_level is distinct from depth level_differs from tree left join stated on stated.key=tree.key",
    "p5_found": _P5 + "select distinct src_table, src_key, ref, reason from found",
    "p5_by_month": _P5 + "select src_table, strftime(seen_at, '%Y-%m') as month, reason, count(*) n_orphans from found group by all",
}
