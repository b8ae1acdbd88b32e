"""The queries of the catalog's own operators, each with the SQL that states the same.

Array results are joined to text, so that engines agree on their form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaloom.config import Config, KeyValue, Naming, Normalization
from schemaloom.functions import naming as N
from schemaloom.functions import parsing as P
from schemaloom.functions import roles as R
from schemaloom.functions.keys import schema_key, target_key
from schemaloom.operators import catalog as C
from schemaloom.operators import graph as G
from schemaloom.operators import load as L
from schemaloom.operators import mapping as M
from schemaloom.operators import suggest as U
from schemaloom.operators.diff import one_per_key
from schemaloom.operators.hierarchy import current_parsed
from schemaloom.operators.references import resolved
from schemaloom.plans import plan
from schemaloom.plans.oracle import _KEY
from schemaloom.session import Workspace, table
from schemaloom.sources import registry as source
from schemaloom.sources.files import NameMapping, RoleOverrides

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


S = """S as (select * from (select *, row_number() over (partition by registry_name, name order by updated_time desc) rn from glue_schemas) where rn=1)"""
V = """V as (select *, schema_name as "name" from (select *, row_number() over (partition by registry_name, schema_name, version_number order by ingested_at desc) rn from glue_versions) where rn=1)"""
LV = f"""{V}, LV as (select registry_name, "name", arg_max({{d: definition}}, version_number).d definition, count(*)::int n_versions from V group by 1,2)"""
SV = f"""{S}, {LV}, SV as (select S.registry_name, S."name", S.data_format, S.compatibility, LV.definition, coalesce(LV.n_versions,0) n_versions from S left join LV on S.registry_name=LV.registry_name and S."name"=LV."name")"""
PS = """P as (select registry_name, "name", registry_name||':'||"name" k, arg_max({r: "references"}, parsed_at).r refs, arg_max({r: fields}, parsed_at).r fields, arg_max({r: record_name}, parsed_at).r record_name from parsed_schemas group by 1,2)"""
COMPLETED = """D as (select key, arg_max(versions, completed_at) versions from completed group by 1)"""


def _join(c: str) -> str:
    return f"array_to_string({c}, ';')"


def sql_words(x: str, mark: str) -> str:
    return rf"trim(regexp_replace(lower(regexp_replace(regexp_replace({x},'[_\- ]+','{mark}','g'),'([^A-Z{mark}])([A-Z])','\1{mark}\2','g')),'{mark}{{2,}}','{mark}','g'),'{mark}')"


_INVALID = r"""regexp_replace({0},'[/: \\<>"|?*]','-','g')"""


def sql_normalize(x: str) -> str:
    return sql_words(f"replace({_INVALID.format(x)},'.','-')", "-")


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x},'(-key|_key|Key|-k|_k)$',''),'(-value|_value|Value|-v|_v)$','')"


def sql_first(x: str, patterns: list[tuple[str, str, str]], what: int) -> str:
    """The role (what=1) or the reason (what=2) of the first pattern that matches."""
    text = lambda p, r, label: r if what == 1 else f"{label}: {p}"
    return "case " + " ".join(f"when regexp_matches({x}, '{p}') then '{text(p, r, label)}'" for p, r, label in patterns) + " end"


BUILT_IN = [(p, "key", "Built-in pattern") for p in R.KEY_PATTERNS] + [(p, "value", "Built-in pattern") for p in R.VALUE_PATTERNS]
BY_RECORD = [(p, r, "Record name pattern") for p, r, _ in BUILT_IN]
FIRST_TEXT = """nullif(regexp_extract(definition, '(?s)"{0}".[: "]*([^: "][^"]*)"', 1), '')"""
RECORD = f"""coalesce(case data_format when 'AVRO' then {FIRST_TEXT.format("name")} when 'JSON' then {FIRST_TEXT.format("title")} when 'PROTOBUF' then nullif(regexp_extract(definition, '(?m)^[ \\t]*message +(\\S+)', 1),'') end, '')"""
SPACE = f"""coalesce(case data_format when 'AVRO' then {FIRST_TEXT.format("namespace")} when 'PROTOBUF' then nullif(regexp_extract(definition, '(?m)^[ \\t]*package ([^;\\n\\r]*)', 1),'') end, '')"""
ROLE = f"""coalesce({sql_first('"name"', BUILT_IN, 1)}, case when record<>'' then {sql_first("record", BY_RECORD, 1)} end, 'value')"""
REASON = f"""coalesce({sql_first('"name"', BUILT_IN, 2)}, case when record<>'' then {sql_first("record", BY_RECORD, 2)} end, 'Default role')"""
RO = f"""{SV}, R0 as (select *, {RECORD} record, {SPACE} space from SV), RO as (select *, {ROLE} as "role", {REASON} reason from R0)"""
SUFFIX = """case when "role"='key' then '-key' else '-value' end"""
TOPIC = f"""{sql_strip(sql_normalize('"name"'))}||{SUFFIX}"""
MAP = f"""{RO}, M as (select registry_name, "name", n_versions, "role", reason, {TOPIC} subject from RO)"""


# --- selection ---------------------------------------------------------------------------------------


@query("registry_get", "select name, arn, description, created_time from registries where name='shared-hub'")
def _(spark, d):
    return C.get_registry(C.registries(spark, d), "shared-hub").select("name", "arn", "description", "created_time")


@query("registry_select_all", r"select name from registries where not (regexp_matches(name,'^[^/]*-dev$') or regexp_matches(name,'^archive-[^/]*$') or starts_with(name,'archive-') or regexp_matches(name,'^billing-[ps][^/]*$') or starts_with(name,'billing-[ps]'))")
def _(spark, d):
    return C.select_registries(C.registries(spark, d), every=True, exclude=["*-dev", "archive-*", "billing-[ps]*"]).select("name")


@query("registry_select_named", "select name from registries where name in ('shared-hub','fleet-dev')")
def _(spark, d):
    return C.select_registries(C.registries(spark, d), names=["shared-hub", "fleet-dev"], exclude=["fleet-*"]).select("name")


@query("schema_glob", f"with {S} select registry_name, name from S where regexp_matches(name, '^[^/]*[-_]key$')")
def _(spark, d):
    return C.filter_schemas(C.schemas(spark, d), "*[-_]key").select("registry_name", "name")


@query("schema_current", f"with {S} select registry_name, name, data_format, compatibility, latest_version, updated_time from S")
def _(spark, d):
    return C.schemas(spark, d).select("registry_name", "name", "data_format", "compatibility", "latest_version", "updated_time")


@query("schema_versions", f"with {SV} select registry_name, name, data_format, n_versions, md5(definition) print from SV")
def _(spark, d):
    return C.with_versions(C.schemas(spark, d), C.versions(spark, d)).select("registry_name", "name", "data_format", "n_versions", F.md5("definition").alias("print"))


@query("latest_version", f"with {V} select registry_name, name, max(version_number) version_number, arg_max(schema_version_id, version_number) schema_version_id from V group by 1,2")
def _(spark, d):
    return C.latest(C.versions(spark, d)).select("registry_name", "name", "version_number", "schema_version_id")


@query("versions_ordered", f"with {V} select registry_name, name, version_number, row_number() over (partition by registry_name, name order by version_number)::int ord from V")
def _(spark, d):
    return C.ordered_versions(C.versions(spark, d)).select("registry_name", "name", "version_number", "ord")


@query("timestamps", "select name, case when regexp_matches(t,'^\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?(Z|[+-]\\d\\d:\\d\\d)$') then cast(cast(t as timestamptz) as timestamp) end created from (select name, case when length(name)%3=0 then strftime(created_time,'%Y-%m-%d') when length(name)%3=1 then strftime(created_time,'%Y-%m-%dT%H:%M:%S')||'+05:30' else strftime(created_time,'%Y-%m-%dT%H:%M:%S')||'Z' end t from registries)")
def _(spark, d):
    n = F.length("name") % 3
    iso = F.date_format("created_time", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(n == 0, F.date_format("created_time", "yyyy-MM-dd")).when(n == 1, F.concat(iso, F.lit("+05:30"))).otherwise(F.concat(iso, F.lit("Z")))
    return C.registries(spark, d).select("name", N.parse_time(text).alias("created"))


def _from_service(spark, d):
    source.register(spark)
    return spark.read.format("schema_registry").option("client", "schemaloom.sources.registry:TablesClient").option("path", d).option("schemas_per_partition", 500).load()


_SERVED = f"""with {S}, {V} select S.registry_name, S."name", S.data_format, V.version_number, V.schema_version_id, md5(V.definition) print from S left join V on V.registry_name=S.registry_name and V."name"=S."name" """


@query("service_versions", _SERVED)
def _(spark, d):
    """Every version, page by page, as a registry service gives them."""
    return _from_service(spark, d).select("registry_name", "name", "data_format", "version_number", "schema_version_id", F.md5("definition").alias("print"))


@query("service_one_registry", _SERVED + "where S.registry_name='shared-hub'")
def _(spark, d):
    """One registry: the filter reaches the service, which is asked for no other."""
    return _from_service(spark, d).where("registry_name = 'shared-hub'").select("registry_name", "name", "data_format", "version_number", "schema_version_id", F.md5("definition").alias("print"))


@query("service_plan", f"""with {MAP}, C as (select registry_name, count(*) n, sum(n_versions)::bigint v from M where registry_name='shared-hub' group by 1), W as (select subject, row_number() over (partition by subject order by "name")-1 i from M where registry_name='shared-hub') select registry_name source_registry, n n_schemas, v n_versions, (select count(*) from W where i>0) n_renamed from C""")
def _(spark, d):
    """A plan over one registry of the service."""
    c = Config()
    c.aws.registry_names = ["shared-hub"]
    p = plan.build(spark, None, c, catalog=C.from_registry(spark, {"client": "schemaloom.sources.registry:TablesClient", "path": d, "schemas_per_partition": "500"}, ["shared-hub"]))
    return p.mappings.groupBy("source_registry").agg(F.count("*").alias("n_schemas"), F.sum("source_versions").alias("n_versions"), F.count(F.when(F.array_contains("transformations", "collision-suffix"), 1)).alias("n_renamed"))


# --- names -------------------------------------------------------------------------------------------

_NAMES = f"""with {S}, X as (select registry_name, name, registry_name||':'||name||'/ v?'||data_format raw from S) select registry_name, name, """


def _raw():
    return F.concat(schema_key("registry_name", "name"), F.lit("/ v?"), "data_format")


def _names(name, sql, expression):
    @query(name, _NAMES + sql + " from X")
    def _(spark, d):
        return C.schemas(spark, d).select("registry_name", "name", *expression())


_names("invalid_chars", _INVALID.format("raw") + r""" as "result", array_to_string(list_transform(regexp_extract_all(raw,'[/: \\<>"|?*]'), lambda x: x||'→-'),';') as log""", lambda: [N.replace_invalid(_raw()).alias("result"), F.array_join(N.invalid_log(_raw()), ";").alias("log")])
_names("dots_keep", 'name as "result"', lambda: [N.handle_dots(F.col("name"), "keep").alias("result")])
_names("dots_replace", "replace(name,'.','_') as \"result\", case when contains(name,'.') then 'dots→_' else '' end as log", lambda: [N.handle_dots(F.col("name"), "replace", "_").alias("result"), F.array_join(N.dots_log(F.col("name"), "replace", "_"), ";").alias("log")])
_names("dots_last", "split_part(name,'.',-1) as \"result\"", lambda: [N.handle_dots(F.col("name"), "extract-last").alias("result")])
_names("case_kebab", sql_words("name", "-") + ' as "result"', lambda: [N.kebab(F.col("name")).alias("result")])
_names("case_snake", sql_words("name", "_") + ' as "result"', lambda: [N.snake(F.col("name")).alias("result")])
_names("case_lower", 'lower(name) as "result"', lambda: [N.change_case(F.col("name"), "lower").alias("result")])
_names(
    "normalize",
    sql_normalize("raw") + r""" as "result", array_to_string(list_concat(list_transform(regexp_extract_all(raw,'[/: \\<>"|?*]'), lambda x: x||'→-'), case when contains(raw,'.') then ['dots→-'] else [] end, case when """ + sql_normalize("raw") + " <> replace(" + _INVALID.format("raw") + ",'.','-') then ['case→kebab'] else [] end),';') as log",
    lambda: [N.normalize(_raw(), Normalization())[0].alias("result"), F.array_join(N.normalize(_raw(), Normalization())[1], ";").alias("log")],
)
_names("strip_suffixes", "regexp_replace(name,'(-key|_key|Key|-k|_k)$','') no_key, regexp_replace(name,'(-value|_value|Value|-v|_v)$','') no_value, regexp_replace(name,'(Id|ID|-id|_id)$','') no_id", lambda: [N.strip_key_suffix(F.col("name")).alias("no_key"), N.strip_value_suffix(F.col("name")).alias("no_value"), N.strip_id_suffix(F.col("name")).alias("no_id")])
_names("clean_subject", "regexp_replace(raw,'[^a-zA-Z0-9._-]','-','g') as \"result\"", lambda: [N.clean_subject(_raw()).alias("result")])
_names("schema_keys", "registry_name||':'||name as key", lambda: [schema_key("registry_name", "name").alias("key")])
_names("truncate", "case when strlen(raw)>24 then substring(raw,1,21)||'...' else raw end as \"result\"", lambda: [N.truncate(_raw(), 24).alias("result")])
_names("path_escape", "replace(replace(replace(raw,'/','%2F'),' ','%20'),'?','%3F') as \"result\"", lambda: [N.path_escape(_raw()).alias("result")])
_names("clean_answer", "name as \"result\"", lambda: [N.clean_answer(F.concat(F.lit("```` \n"), F.col("name"), F.lit(" \t\n```"))).alias("result")])

# --- definitions -------------------------------------------------------------------------------------

_OK = "json_valid(definition) and regexp_matches(definition,'^\\s*\\{')"


@query("avro_meta", f"""with {SV} select registry_name, "name", case when {_OK} then definition->>'$.name' end record_name, case when {_OK} then definition->>'$.namespace' end namespace, case when {_OK} then definition->>'$.doc' end documentation, coalesce({_OK}, false) ok from SV where data_format='AVRO'""")
def _(spark, d):
    a = P.avro(F.col("definition"))
    return _with(spark, d, "AVRO").withColumn("a", a).select("registry_name", "name", "a.record_name", "a.namespace", "a.documentation", "a.ok")


def _with(spark, d, data_format):
    s = C.schemas(spark, d).where(F.col("data_format") == data_format)
    return C.with_versions(s, C.versions(spark, d)).select("registry_name", "name", "data_format", "definition")


_T = """case json_type({0}) when 'VARCHAR' then {0}->>'$' when 'OBJECT' then {1} when 'ARRAY' then {2} else 'unknown' end"""
_OBJ = """case when json_type({0},'$.type')='VARCHAR' then {0}->>'$.type' end"""
_ONE = f"""case json_type(x) when 'VARCHAR' then x->>'$' when 'OBJECT' then {_OBJ.format("x")} end"""
_TYPE = _T.format("t", f"coalesce({_OBJ.format('t')},'unknown')", f"array_to_string(list_filter(list_transform(json_extract(t,'$[*]'), lambda x: {_ONE}), lambda y: y is not null),'|')")
_PRIM = ",".join(f"'{p}'" for p in P.PRIMITIVES)
_REF1 = "case json_type({0}) when 'VARCHAR' then case when ({0}->>'$') not in (" + _PRIM + ") then {0}->>'$' end when 'OBJECT' then case when json_extract({0},'$.type') is null then {0}->>'$.name' end end"
_REF = f"""case when json_type(t)='ARRAY' then list_filter(list_transform(json_extract(t,'$[*]'), lambda x: {_REF1.format("x")}), lambda y: y is not null and y<>'')[1] else {_REF1.format("t")} end"""


@query("avro_fields", f"""with {SV}, A as (select registry_name, "name", json_extract(definition,'$.fields[*]') fs from SV where data_format='AVRO' and {_OK}), B as (select registry_name, "name", unnest(fs) f, unnest(range(len(fs))) pos from A), B2 as (select *, f->'$.type' t from B) select registry_name, "name", pos::int pos, f->>'$.name' field_name, {_TYPE} as "type", f->>'$.doc' doc, {_REF} "reference" from B2""")
def _(spark, d):
    f = _with(spark, d, "AVRO").withColumn("d", F.from_json(F.when(P.whole_json(F.col("definition")), F.col("definition")), P._AVRO))
    e = f.select("registry_name", "name", F.posexplode("d.fields").alias("pos", "f"))
    return e.select("registry_name", "name", "pos", F.col("f.name").alias("field_name"), P.avro_type(F.col("f.type")).alias("type"), F.col("f.doc").alias("doc"), P.avro_reference(F.col("f.type")).alias("reference"))


@query("avro_references", f"""with {SV}, A as (select registry_name, "name", json_extract(definition,'$.fields[*]') fs from SV where data_format='AVRO' and {_OK}), B as (select registry_name, "name", (unnest(fs))->'$.type' t from A), C as (select distinct registry_name, "name", {_REF} ref from B) select * from C where ref is not null""")
def _(spark, d):
    return _with(spark, d, "AVRO").select("registry_name", "name", F.explode(P.avro(F.col("definition"))["references"]).alias("ref"))


@query("json_fields", f"""with {SV}, A as (select registry_name, "name", json_extract(definition,'$.properties') p, json_keys(definition,'$.properties') ks, coalesce(json_extract_string(definition,'$.required[*]'), []) req from SV where data_format='JSON' and {_OK}), B as (select registry_name, "name", p, req, unnest(ks) k from A), C as (select *, json_extract(p, '$."'||k||'"') v from B) select registry_name, "name", k field_name, case when json_type(v,'$.type')='VARCHAR' then v->>'$.type' end as "type", list_contains(req,k) is_required, v->>'$."$ref"' "reference" from C""")
def _(spark, d):
    j = P.json_schema(F.col("definition"))
    e = _with(spark, d, "JSON").withColumn("j", j).select("registry_name", "name", "definition", F.explode("j.fields").alias("f"))
    props = F.from_json("definition", "properties map<string,string>")["properties"]
    return e.select("registry_name", "name", F.col("f.name").alias("field_name"), F.col("f.type").alias("type"), F.col("f.is_required").alias("is_required"), F.get_json_object(F.try_element_at(props, F.col("f.name")), "$['$ref']").alias("reference"))


_PROTO = """list_transform(string_split({0}, chr(10)), lambda x: trim(x, chr(32)||chr(9)||chr(13)||chr(11)||chr(12)))"""


@query("proto_meta", f"""with {SV}, A as (select registry_name, "name", {_PROTO.format("definition")} ls from SV where data_format='PROTOBUF') select registry_name, "name", list_filter(list_transform(ls, lambda x: regexp_extract(x,'^message +(\\S+)',1)), lambda x: x<>'')[1] first_message, list_filter(list_transform(ls, lambda x: regexp_extract(x,'^message +(\\S+)',1)), lambda x: x<>'')[-1] last_message, regexp_replace(list_filter(ls, lambda x: starts_with(x,'package '))[-1][9:],';$','') namespace from A""")
def _(spark, d):
    a, b = P.proto(F.col("definition"), "first"), P.proto(F.col("definition"), "last")
    return _with(spark, d, "PROTOBUF").select("registry_name", "name", a["record_name"].alias("first_message"), b["record_name"].alias("last_message"), b["namespace"].alias("namespace"))


@query("light_meta", f"""with {SV} select registry_name, "name", {RECORD} record, {SPACE} "space" from SV""")
def _(spark, d):
    s = C.with_versions(C.schemas(spark, d), C.versions(spark, d))
    r, n = P.light_metadata(F.col("definition"), F.col("data_format"))
    return s.select("registry_name", "name", r.alias("record"), n.alias("space"))


# --- roles -------------------------------------------------------------------------------------------


def _detected(spark, d, settings, overrides=None, structure=False):
    s = C.with_versions(C.schemas(spark, d), C.versions(spark, d))
    r, _ = P.light_metadata(F.col("definition"), F.col("data_format"))
    s = s.withColumn("record", r)
    return s.withColumn("found", R.detect(F.col("registry_name"), F.col("name"), F.col("record"), None, settings, overrides)).select("registry_name", "name", "found.role", "found.reason")


@query("role_builtin", f"""with {RO} select registry_name, "name", "role", reason from RO""")
def _(spark, d):
    return _detected(spark, d, KeyValue())


_USER = [("-created$", "key", "User pattern"), ("(?i)moved", "key", "User pattern"), ("[0-9]", "value", "User pattern")]
_USER_RECORD = [(p, r, "Record name pattern") for p, r, _ in _USER]


@query("role_user", f"""with {RO} select registry_name, "name", coalesce({sql_first('"name"', _USER, 1)}, case when record<>'' then {sql_first("record", _USER_RECORD, 1)} end, 'key') as "role", coalesce({sql_first('"name"', _USER, 2)}, case when record<>'' then {sql_first("record", _USER_RECORD, 2)} end, 'Default role') reason from RO""")
def _(spark, d):
    return _detected(spark, d, KeyValue(key_regex=["-created$", "(?i)moved"], value_regex=["[0-9]"], default_role="key", disable_builtin_patterns=True))


@query("role_registry", f"""with {RO} select registry_name, "name", case when registry_name='shared-hub' and regexp_matches("name",'^c') then 'key' else "role" end as "role", case when registry_name='shared-hub' and regexp_matches("name",'^c') then 'Registry pattern: ^c' else reason end reason from RO""")
def _(spark, d):
    return _detected(spark, d, KeyValue(), RoleOverrides({}, registries={"shared-hub": {"key_patterns": ["^c"]}}))


@query("role_override", f"""with {RO}, K as (select max("name") n, min(registry_name||'.'||"name") k from S) select registry_name, "name", case when "name"=K.n then 'key' when registry_name||'.'||"name"=K.k then 'value' else "role" end as "role", case when "name"=K.n or registry_name||'.'||"name"=K.k then 'Override file' else reason end reason from RO, K""")
def _(spark, d):
    k = C.schemas(spark, d).agg(F.max("name").alias("n"), F.min(F.concat_ws(".", "registry_name", "name")).alias("k")).first()
    return _detected(spark, d, KeyValue(), RoleOverrides({k["n"]: "key", k["k"]: "value"}))


@query("role_structure", f"""with {PS} select registry_name, "name", case when len(fields) between 1 and 3 and len(list_filter(fields, lambda f: regexp_matches(lower(f."name"),'id|key|uuid|partition_key|entity_id|pk')))>0 then 'key' when len(fields)>5 then 'value' end as "role" from P""")
def _(spark, d):
    p = table(spark, d, "parsed_schemas", "registry_name", "name", "fields", "parsed_at")
    p = p.groupBy("registry_name", "name").agg(F.max_by("fields", "parsed_at").alias("fields"))
    return p.select("registry_name", "name", R.by_structure(F.col("fields"))["role"].alias("role"))


# --- mapping -----------------------------------------------------------------------------------------


def _mapped(spark, d, c=None, **how):
    return M.map_schemas(C.with_versions(C.schemas(spark, d), C.versions(spark, d)), c or Config(), **how)


_OUT = ("source_registry", "source_schema_name", "target_context", "target_subject", "detected_role", "naming_strategy")


@query("subject_topic", f"""with {MAP} select registry_name source_registry, "name" source_schema_name, n_versions source_versions, '' target_context, subject target_subject, "role" detected_role, reason naming_reason, 'ready' status from M""")
def _(spark, d):
    return _mapped(spark, d).select("source_registry", "source_schema_name", "source_versions", "target_context", "target_subject", "detected_role", "naming_reason", "status")


_FULL = """case when record='' then "name" when space='' then record else space||'.'||record end"""


@query("subject_record", f"""with {RO} select registry_name source_registry, "name" source_schema_name, '.'||registry_name target_context, {sql_normalize(_FULL)}||{SUFFIX} target_subject, "role" detected_role, 'record' naming_strategy from RO""")
def _(spark, d):
    return _mapped(spark, d, Config(naming=Naming(subject_strategy="record", context_mapping="registry"))).select(*_OUT)


@query("subject_template", f"""with {RO} select registry_name source_registry, "name" source_schema_name, case when registry_name='shared-hub' then '.hub' else '.'||registry_name end target_context, {sql_normalize("registry_name||'-'||record||'.x'||" + SUFFIX)} target_subject, "role" detected_role, 'custom' naming_strategy from RO""")
def _(spark, d):
    return _mapped(spark, d, Config(naming=Naming(subject_strategy="custom", subject_template="{{.registry}}-{record_name}.x{{.suffix}}", context_mapping="custom")), contexts={"shared-hub": "hub"}).select(*_OUT)


_CUSTOM = f"""{MAP}, K as (select min(registry_name||':'||"name") k, max("name") n from S)"""


@query("custom_mapping", f"""with {_CUSTOM} select registry_name source_registry, "name" source_schema_name, case when registry_name||':'||"name"=K.k then '.own' else '' end target_context, case when registry_name||':'||"name"=K.k then 'one-key' when "name"=K.n then 'any-value' else subject end target_subject, case when registry_name||':'||"name"=K.k then 'key' else "role" end detected_role, case when registry_name||':'||"name"=K.k or "name"=K.n then 'custom-mapping' else 'topic' end naming_strategy from M, K""")
def _(spark, d):
    k = C.schemas(spark, d).agg(F.min(schema_key("registry_name", "name")).alias("k"), F.max("name").alias("n")).first()
    return _mapped(spark, d, names=[NameMapping(k["k"], "one-key", "key", ".own"), NameMapping(k["n"], "any-value")]).select(*_OUT)


def _members(sql_target: str, where: str = "") -> str:
    return f"""with {MAP}, W as (select registry_name source_registry, "name" source_schema_name, subject, count(*) over (partition by subject) n, row_number() over (partition by subject order by registry_name, "name")-1 i, row_number() over (partition by subject order by strlen("name"), registry_name, "name")-1 j from M) select source_registry, source_schema_name, {sql_target} from W {where}"""


@query("collisions", f"""with {MAP} select subject normalized_name, count(*) n_sources from M group by 1 having count(*)>1""")
def _(spark, d):
    return M.collisions(_mapped(spark, d))


@query("collision_members", f"""with {MAP} select subject normalized_name, registry_name||'.'||"name" source from M where subject in (select subject from M group by 1 having count(*)>1)""")
def _(spark, d):
    return M.collision_members(Workspace(spark, "members").save(_mapped(spark, d)))


for _how, _sql in {
    "suffix": "case when i>0 then subject||'-'||i::varchar else subject end target_subject, 'ready' status",
    "registry-prefix": "case when n>1 then source_registry||'-'||subject else subject end target_subject, 'ready' status",
    "prefer-shorter": "subject target_subject, case when j>0 then 'skipped' else 'ready' end status",
    "skip": "subject target_subject, case when i>0 then 'skipped' else 'ready' end status",
}.items():
    QUERIES[f"resolve_{_how.replace('-', '_')}"] = lambda spark, d, how=_how: M.resolve_collisions(_mapped(spark, d), how).select("source_registry", "source_schema_name", "target_subject", "status")
    ORACLE[f"resolve_{_how.replace('-', '_')}"] = _members(_sql)


@query("resolve_suffix_observed", _members("case when i>0 then subject||'-'||chr((ord('0')+i)::int) else subject end target_subject"))
def _(spark, d):
    return M.resolve_collisions(_mapped(spark, d), "suffix", observed=True).select("source_registry", "source_schema_name", "target_subject")


# --- checks on the mappings table --------------------------------------------------------------------


_ODD_SUBJECT = "case length(source_schema_name)%5 when 0 then '_'||target_subject when 1 then target_subject||' x' when 2 then '' when 3 then 'shared' else target_subject end"
_ODD_CONTEXT = "case length(source_registry)%3 when 0 then target_context when 1 then source_registry else '.'||source_registry||'.x' end"


@query("validate_errors", rf"""with X as (select source_registry||'.'||source_schema_name as "schema", {_ODD_SUBJECT} t, {_ODD_CONTEXT} c from mappings), Y as (select *, {_KEY.format("c", "t")} k from X)
select "schema", m as message from (select *, case when t='' then 'subject name cannot be empty' when strlen(t)>255 then 'subject name exceeds maximum length of 255 characters' when not regexp_matches(t,'^[a-zA-Z0-9._-]+$') then 'subject name contains invalid characters (only alphanumeric, dots, underscores, and hyphens allowed)' when starts_with(t,'_') then 'subject name cannot start with underscore (reserved)' end m from X) where m is not null
union all select "schema", case when not starts_with(c,'.') then 'context must start with a dot' else 'context name contains invalid characters' end from X where c<>'' and not regexp_matches(c,'^\.[a-zA-Z0-9_-]+$')
union all select "schema", 'Naming collision: multiple schemas map to '||k from Y where k in (select k from Y group by 1 having count(*)>1)""")
def _(spark, d):
    m = table(spark, d, "mappings").withColumn("t", F.expr(_ODD_SUBJECT)).withColumn("target_context", F.expr(_ODD_CONTEXT)).drop("target_subject").withColumnRenamed("t", "target_subject")
    return M.findings(m).where("severity = 'error'").select("schema", "message")


@query("validate_warnings", r"""with W as (select source_registry||'.'||source_schema_name as "schema", source_schema_name s, target_subject t, "references" r from mappings)
select "schema", 'Schema name changed significantly: '||s||' → '||t message from W where s<>t and lower(replace(s,'_','-')) <> regexp_replace(regexp_replace(lower(t),'-key$',''),'-value$','')
union all select "schema", 'Name contains special character '''||case when contains(s,'/') then '/' when contains(s,':') then ':' when contains(s,' ') then ' ' else '\' end||''' which will be replaced' from W where regexp_matches(s,'[/: \\]')
union all select "schema", 'Name has AWS-specific prefix '''||regexp_extract(s,'^(MSK_|Glue_|AWS_)')||''' which may be removed' from W where regexp_matches(s,'^(MSK_|Glue_|AWS_)')
union all select "schema", 'Name contains version suffix which may be removed' from W where regexp_matches(s,'[_-]v[12]|_V[12]')
union all select "schema", 'Schema has references but reference strategy is not ''rewrite''' from W where len(r)>0""")
def _(spark, d):
    return M.findings(table(spark, d, "mappings"), "skip").where("severity = 'warning'").select("schema", "message")


# --- graph -------------------------------------------------------------------------------------------

EDGES = f"""{PS}, r as (select k, registry_name, unnest(refs) ref from P where len(refs)>0), byname as (select "name", min(k) k from P group by 1), E as (select distinct r.k src, case when a.k is not null then a.k when o.k is not null then o.k else n.k end dst from r left join P a on a.k=r.ref left join P o on o.k=r.registry_name||':'||r.ref left join byname n on n."name"=r.ref), G as (select src, dst from E where dst is not null and src<>dst)"""


PLAN_EDGES = f"""{PS}, r as (select k, registry_name, unnest(refs) ref from P where len(refs)>0), N as (select registry_name, "name", registry_name||':'||"name" k from S), byname as (select "name", min(k) k from N group by 1), E as (select distinct r.k src, case when a.k is not null then a.k when o.k is not null then o.k else n.k end dst from r left join N a on a.k=r.ref left join N o on o.k=r.registry_name||':'||r.ref left join byname n on n."name"=r.ref), G as (select src, dst from E where dst is not null and src<>dst)"""


@query("reference_edges", f"with {EDGES} select src, dst from G")
def _(spark, d):
    return G.catalog_edges(spark, d)


@query("edge_degrees", f"with {EDGES} select key, sum(o)::bigint n_dependencies, sum(i)::bigint n_dependents from (select src as key, 1 o, 0 i from G union all select dst, 0, 1 from G) group by 1")
def _(spark, d):
    return G.degrees(G.catalog_edges(spark, d))


@query("edge_lists", f"with {EDGES}, A as (select src as key, array_to_string(list_sort(list(dst)),';') a from G group by 1), B as (select dst as key, array_to_string(list_sort(list(src)),';') b from G group by 1) select coalesce(A.key,B.key) as key, coalesce(a,'') dependencies, coalesce(b,'') dependents from A full join B on A.key=B.key")
def _(spark, d):
    n = G.neighbours(G.catalog_edges(spark, d))
    return n.select("key", F.array_join("dependencies", ";").alias("dependencies"), F.array_join("dependents", ";").alias("dependents"))


_LEVELS = f"with recursive {EDGES}, L(k, level) as (select k, 0 from P union select g.src, L.level+1 from L join G g on g.dst=L.k where L.level<400), T as (select k, max(level) level from L group by 1)"


@query("topo_levels", _LEVELS + " select k as key, level::int as level from T where level<400")
def _(spark, d):
    return G.catalog_levels(spark, d)[0]


@query("cycle_nodes", _LEVELS + " select k as key from T where level>=400")
def _(spark, d):
    return G.catalog_levels(spark, d)[1]


@query("migration_order", _LEVELS + " select row_number() over (order by level, k) ord, level::int as level, k as key from T where level<400")
def _(spark, d):
    return G.migration_order(G.catalog_levels(spark, d)[0])


@query("observed_level", f"with {EDGES} select k as key, 0 as level from P where k not in (select dst from G)")
def _(spark, d):
    keys = current_parsed(spark, d).select(schema_key("registry_name", "name").alias("key"))
    return G.observed_level(keys, G.catalog_edges(spark, d))


# --- loading -----------------------------------------------------------------------------------------

_OREF = """list_transform({0}, lambda r: {{'name': case when contains(r,':') then substring(r, strpos(r,':')+1) else r end, 'subject': case when contains(r,':') then '.'||split_part(r,':',1)||':'||substring(r, strpos(r,':')+1)||'-value' when {1}='' then r||'-value' else {1}||':'||r||'-value' end, 'version': 1}})"""


@query("reference_rewrite", f"""with M as (select source_registry, source_schema_name, unnest({_OREF.format('"references"', "coalesce(target_context,'')")}) x from mappings) select source_registry, source_schema_name, x."name" as "name", x.subject subject, x.version as "version" from M""")
def _(spark, d):
    m = table(spark, d, "mappings", "source_registry", "source_schema_name", "target_context", "references")
    return m.select("source_registry", "source_schema_name", F.explode(L.observed_references(F.col("references"), F.coalesce("target_context", F.lit("")))).alias("x")).select("source_registry", "source_schema_name", "x.name", "x.subject", "x.version")


_MAPPED = f"""{PS}, N as (select registry_name, "name", registry_name||':'||"name" k from S), byname as (select "name", min(k) k from N group by 1), r as (select k, registry_name, unnest(refs) ref, unnest(range(len(refs))) pos from P where len(refs)>0), E as (select r.k src, r.pos, r.ref, case when a.k is not null then a.k when o.k is not null then o.k else n.k end dst from r left join N a on a.k=r.ref left join N o on o.k=r.registry_name||':'||r.ref left join byname n on n."name"=r.ref), C as (select registry_name||':'||"name" k, count(*)::int n from V group by 1), T as (select {_KEY.format("target_context", "target_subject")} subject, source_registry||':'||source_schema_name k from mappings), X as (select src, pos::int pos, case when ref=dst then substring(ref, strpos(ref,':')+1) else ref end as "name", T.subject, coalesce(C.n,1) as "version" from E join T on T.k=E.dst left join C on C.k=E.dst)"""


def _mapped_references(spark, d):
    versions = C.versions(spark, d).groupBy(schema_key("registry_name", "name").alias("source")).agg(F.count("*").alias("version"))
    return L.mapped_references(resolved(current_parsed(spark, d), C.schemas(spark, d)), table(spark, d, "mappings"), versions)


@query("reference_mapped", f"""with {S}, {V}, {_MAPPED} select * from X""")
def _(spark, d):
    return _mapped_references(spark, d)


@query("reference_bodies", f"""with {S}, {V}, {_MAPPED} select src as key, '['||string_agg('{{"name":"'||"name"||'","subject":"'||subject||'","version":'||"version"||'}}', ',' order by pos)||']' as "references" from X where src in (select k from T) and src in (select k from C) and src in (select k from N) group by 1""")
def _(spark, d):
    """The references in the bodies of a run over the mappings table, one row per schema."""
    m = table(spark, d, "mappings")
    c = Config()
    p = plan.Plan(C.schemas(spark, d), C.versions(spark, d), m, resolved(current_parsed(spark, d), C.schemas(spark, d)), c)
    v = C.versions(spark, d).select(schema_key("registry_name", "name").alias("key"), "version_number", "definition")
    b = plan.bodies(p, v).select("key", F.get_json_object("body", "$.references").alias("references"))
    return b.where("references is not null").distinct()


@query("register_payload", f"""with {V} select schema_version_id, '/subjects/'||{_KEY.format("m.target_context", "m.target_subject")}||'/versions' path, md5(to_json({{'schema': v.definition, 'schemaType': s.data_format}})::varchar) print from V v join mappings m on m.source_registry=v.registry_name and m.source_schema_name=v."name" join (select distinct registry_name, name n, data_format from glue_schemas) s on s.registry_name=v.registry_name and s.n=v."name" where v.definition is not null and m.status in ('ready','warning') and not regexp_matches({_KEY.format("m.target_context", "m.target_subject")}, '[^a-zA-Z0-9._:-]') and position('\\' in v.definition)=0""")
def _(spark, d):
    m = table(spark, d, "mappings").where("status in ('ready', 'warning')").select(F.col("source_registry").alias("registry_name"), F.col("source_schema_name").alias("name"), "target_context", "target_subject")
    s = C.schemas(spark, d).select("registry_name", "name", "data_format")
    j = C.versions(spark, d).where("definition is not null").join(m, ["registry_name", "name"]).join(s, ["registry_name", "name"])
    ok = ~M.full_target().rlike("[^a-zA-Z0-9._:-]") & ~F.col("definition").contains("\\")
    return j.where(ok).select("schema_version_id", L.register_path().alias("path"), F.md5(L.register_body(F.col("definition"), L.schema_type(F.col("data_format")))).alias("print"))


@query("subject_exists", f"""select source_registry, source_schema_name from mappings m where {_KEY.format("target_context", "target_subject")} in (select {_KEY.format("context", "name")} from subjects)""")
def _(spark, d):
    return L.existing(table(spark, d, "mappings"), table(spark, d, "subjects", "context", "name")).select("source_registry", "source_schema_name")


@query("subject_list", f"""select distinct {_KEY.format("context", "name")} subject from subjects""")
def _(spark, d):
    return table(spark, d, "subjects", "context", "name").select(target_key("context", "name").alias("subject")).distinct()


@query("ledger_current", f"with {COMPLETED} select key, versions from D")
def _(spark, d):
    c = table(spark, d, "completed", "key", "versions", "completed_at")
    return one_per_key(c, ["key"], F.col("completed_at")).select("key", "versions")


@query("resume", "select source_registry||':'||source_schema_name as key from mappings where status not in ('error','skipped') and source_registry||':'||source_schema_name not in (select key from completed)")
def _(spark, d):
    return L.to_send(table(spark, d, "mappings"), table(spark, d, "completed", "key")).select("key")


_STATE = """case when d.key is not null then 'done' when m.status in ('error','skipped') then 'skipped' else 'open' end"""


@query("level_outcomes", _LEVELS + f""", X as (select T.level, {_STATE} st from T join mappings m on T.k=m.source_registry||':'||m.source_schema_name left join (select distinct key from completed) d on d.key=T.k where T.level<400) select level::int as level, count(*) filter (st='done') n_done, 0::bigint n_failed, count(*) filter (st='skipped') n_skipped, count(*) filter (st='open') n_open from X group by 1""")
def _(spark, d):
    return L.outcomes(G.catalog_levels(spark, d)[0], table(spark, d, "mappings"), table(spark, d, "completed", "key"))


@query("progress", "select total, completed, case when total=0 then 0 else 100.0::double*completed/total end percent, completed>=total is_complete from (select (select count(*) from mappings) total, (select count(distinct key) from completed) completed)")
def _(spark, d):
    return L.progress(table(spark, d, "mappings"), table(spark, d, "completed", "key"))


# --- the plan as a whole ------------------------------------------------------------------------------


def _plan(spark, d):
    c = Config()
    c.aws.registry_all = True
    return plan.build(spark, d, c)


@query("plan_summary", f"""with {MAP}, W as (select registry_name, "name", n_versions, subject, row_number() over (partition by subject order by registry_name, "name")-1 i from M), X as (select *, case when i>0 then subject||'-'||i::varchar else subject end t from W), {PS}, Q as (select count(distinct registry_name) registries, count(*) schemas, sum(n_versions)::bigint versions, count(*) ready, 0::bigint errors, 0::bigint skipped from X), Z as (select sum(len(refs))::bigint "references" from P join X on P.registry_name=X.registry_name and P."name"=X."name"), Y as (select count(*) warnings from (select 1 from X where "name"<>t and lower(replace("name",'_','-')) <> regexp_replace(regexp_replace(lower(t),'-key$',''),'-value$','') union all select 1 from X where regexp_matches("name",'[/: \\\\]') union all select 1 from X where regexp_matches("name",'^(MSK_|Glue_|AWS_)') union all select 1 from X where regexp_matches("name",'[_-]v[12]|_V[12]'))) select Q.*, Z."references", Y.warnings, (select count(*) from (select t from X group by 1 having count(*)>1)) collisions from Q, Z, Y""")
def _(spark, d):
    return plan.summary(_plan(spark, d))


@query("plan_by_registry", f"""with {SV}, {PLAN_EDGES}, C as (select split_part(src,':',1) g, count(*) n from G where split_part(src,':',1)<>split_part(dst,':',1) group by 1) select SV.registry_name source_registry, count(*) n_schemas, sum(n_versions)::bigint n_versions, coalesce(max(C.n),0) cross_refs from SV left join C on C.g=SV.registry_name group by 1""")
def _(spark, d):
    return plan.by_registry(_plan(spark, d))


@query("status_counts", "select status, count(*) n from mappings group by 1")
def _(spark, d):
    return table(spark, d, "mappings", "status").groupBy("status").agg(F.count("*").alias("n"))


# --- suggested names ----------------------------------------------------------------------------------


_ONE_PLAIN = """case when json_type(x)='VARCHAR' then x->>'$' end"""
_PROMPT_TYPE = f"""coalesce(case json_type(t) when 'VARCHAR' then t->>'$' when 'OBJECT' then coalesce(case when json_type(t,'$.type')='VARCHAR' then t->>'$.type' end, case when json_type(t,'$.name')='VARCHAR' then t->>'$.name' end) when 'ARRAY' then nullif(array_to_string(list_filter(list_transform(json_extract(t,'$[*]'), lambda x: {_ONE_PLAIN}), lambda y: y is not null),'|'),'') end, 'complex')"""


@query("suggestion_context", f"""with {SV}, A as (select registry_name, "name", data_format, definition, json_extract(definition,'$.fields[*]') fs from SV where data_format='AVRO' and {_OK}),
A2 as (select registry_name, "name", coalesce(definition->>'$.name','') record_name, coalesce(definition->>'$.doc','') doc, len(fs)::int n, list_transform(fs[1:10], lambda f: coalesce(f->>'$.name','')||' ('||(list_transform([f->'$.type'], lambda t: {_PROMPT_TYPE}))[1]||')') ks from A),
J as (select registry_name, "name", definition, json_extract(definition,'$.properties') p, list_sort(json_keys(definition,'$.properties')) names from SV where data_format='JSON' and {_OK}),
J2 as (select registry_name, "name", coalesce(definition->>'$.title','') record_name, coalesce(definition->>'$.description','') doc, coalesce(len(names),0)::int n, coalesce(list_transform(names[1:10], lambda k: k||' ('||coalesce(case when json_type(p,'$."'||k||'".type')='VARCHAR' then json_extract_string(p,'$."'||k||'".type') end,'object')||')'),[]) ks from J),
L as (select registry_name, "name", {_PROTO.format("definition")} ls from SV where data_format='PROTOBUF' and definition is not null),
L2 as (select registry_name, "name", ls, list_filter(ls, lambda x: contains(x,'=') and not starts_with(x,'//') and not starts_with(x,'option')) fl from L),
L3 as (select registry_name, "name", coalesce(list_filter(list_transform(ls, lambda x: regexp_extract(x,'^message +(\\S+)',1)), lambda x: x<>'')[1],'') record_name, '' doc, len(fl)::int n, list_transform(list_filter(fl, lambda x: regexp_matches(x,'^\\S+\\s+\\S'))[1:10], lambda x: regexp_extract(x,'^(\\S+)\\s+(\\S+)',2)||' ('||regexp_extract(x,'^(\\S+)\\s+(\\S+)',1)||')') ks from L2)
select registry_name, "name", record_name, case when strlen(doc)>200 then substring(doc,1,197)||'...' else doc end documentation, n field_count, array_to_string(ks,', ') key_fields from (select * from A2 union all select * from J2 union all select * from L3)""")
def _(spark, d):
    s = C.with_versions(C.schemas(spark, d), C.versions(spark, d))
    whole = P.whole_json(F.col("definition")) | ((F.col("data_format") == "PROTOBUF") & F.col("definition").isNotNull())
    x = s.where(whole).withColumn("c", U.context(F.col("definition"), F.col("data_format")))
    return x.select("registry_name", "name", "c.record_name", "c.documentation", "c.field_count", F.array_join("c.key_fields", ", ").alias("key_fields"))


def _prompts(spark, d):
    s = C.with_versions(C.schemas(spark, d), C.versions(spark, d))
    role = R.detect(F.col("registry_name"), F.col("name"), F.lit(""), None, KeyValue())["role"]
    return s.select("registry_name", "name", U.prompt(F.col("registry_name"), F.col("name"), F.col("data_format"), U.context(F.col("definition"), F.col("data_format")), role).alias("prompt"))


@query("suggestions", f"""with {RO}, X as (select registry_name, "name", coalesce({sql_first('"name"', BUILT_IN, 1)}, 'value') r from RO) select registry_name, "name", case when length("name")%3=0 then 'kept-'||"name" else replace(replace(lower("name"),'_','-'),'.','-')||'-'||r end suggested, length("name")%3=0 is_cached from X""")
def _(spark, d):
    # Every third schema has a cached answer, which goes before a new one.
    kept = C.schemas(spark, d).where(F.length("name") % 3 == 0).select("registry_name", "name", F.concat(F.lit("kept-"), "name").alias("suggested"))
    return U.suggestions(_prompts(spark, d), kept, U.Fixed)[0].select("registry_name", "name", "suggested", "is_cached")


@query("suggestion_cost", f"with {S} select count(*) n_calls, count(*)*0.25::double as cost from S")
def _(spark, d):
    return U.totals(U.ask(_prompts(spark, d), _quarter))


def _quarter():
    return U.Fixed(0.25)
