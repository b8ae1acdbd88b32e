"""Metadata of definitions (Avro, JSON Schema, proto text) as expressions over their text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIMITIVES = ("null", "boolean", "int", "long", "float", "double", "bytes", "string")

_AVRO = "name string, namespace string, doc string, fields array<struct<name:string,type:string,doc:string>>"
_JSON = "title string, description string, properties map<string,string>, required array<string>"


def whole_json(text: Column) -> Column:
    """Whether a text is an undamaged JSON object; from_json alone would take what stands before the damage."""
    return F.coalesce(text.rlike(r"\A\s*\{") & F.try_parse_json(text).isNotNull(), F.lit(False))


def _members(raw: Column) -> Column:
    return F.from_json(raw, "array<string>")


def _object_type(raw: Column) -> Column:
    kind = F.get_json_object(raw, "$.type")
    return F.when(~kind.rlike(r"\A\s*[\[{]"), kind)


def avro_type(raw: Column) -> Column:
    """A field's type as text: a name, an object's type, a union's members joined by |, else unknown."""
    one = lambda x: F.when(x.startswith("{"), _object_type(x)).when(~x.startswith("["), x)
    union = F.array_join(F.filter(F.transform(_members(raw), one), lambda x: x.isNotNull()), "|")
    return F.when(raw.startswith("["), union).when(raw.startswith("{"), F.coalesce(_object_type(raw), F.lit("unknown"))).otherwise(F.coalesce(raw, F.lit("unknown")))


def avro_reference(raw: Column) -> Column:
    """The named type that a field's type refers to, else null; of a union the first."""
    def one(x: Column) -> Column:
        named = F.when(F.get_json_object(x, "$.type").isNull(), F.get_json_object(x, "$.name"))
        return F.when(x.startswith("{"), named).when(~x.startswith("[") & ~x.isin(*PRIMITIVES), x)

    first = F.try_element_at(F.filter(F.transform(_members(raw), one), lambda x: x.isNotNull() & (x != "")), F.lit(1))
    return F.when(raw.startswith("["), first).otherwise(one(raw))


def avro(definition: Column) -> Column:
    """struct(record_name, namespace, documentation, fields, references, ok) of an Avro definition."""
    ok = whole_json(definition)
    d = F.from_json(F.when(ok, definition), _AVRO)
    named = F.filter(d["fields"], lambda f: f["name"].isNotNull())
    fields = F.transform(named, lambda f: F.struct(f["name"].alias("name"), avro_type(f["type"]).alias("type"), F.lit(False).alias("is_required"), f["doc"].alias("doc")))
    refs = F.array_distinct(F.filter(F.transform(named, lambda f: avro_reference(f["type"])), lambda x: x.isNotNull()))
    return F.struct(d["name"].alias("record_name"), d["namespace"].alias("namespace"), d["doc"].alias("documentation"), fields.alias("fields"), refs.alias("references"), ok.alias("ok"))


def json_schema(definition: Column) -> Column:
    """As avro(), of a JSON Schema; fields in order of their names."""
    ok = whole_json(definition)
    d = F.from_json(F.when(ok, definition), _JSON)
    entries = F.array_sort(F.map_entries(d["properties"]))
    text_type = lambda p: F.when(~F.get_json_object(p, "$.type").rlike(r"\A\s*[\[{]"), F.get_json_object(p, "$.type"))
    fields = F.transform(entries, lambda e: F.struct(e["key"].alias("name"), text_type(e["value"]).alias("type"), F.coalesce(F.array_contains(d["required"], e["key"]), F.lit(False)).alias("is_required"), F.lit(None).cast("string").alias("doc")))
    refs = F.array_distinct(F.filter(F.transform(entries, lambda e: F.get_json_object(e["value"], "$['$ref']")), lambda x: x.isNotNull()))
    return F.struct(d["title"].alias("record_name"), F.lit(None).cast("string").alias("namespace"), d["description"].alias("documentation"), fields.alias("fields"), refs.alias("references"), ok.alias("ok"))


def _lines(definition: Column) -> Column:
    return F.transform(F.split(definition, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\v\f")))


def _after(lines: Column, word: str) -> Column:
    return F.transform(F.filter(lines, lambda x: x.startswith(word + " ")), lambda x: F.substring(x, len(word) + 2, 1 << 20))


def _token(c: Column) -> Column:
    return F.regexp_extract(c, r"\A\s*(\S+)", 1)


def proto(definition: Column, message: str = "last") -> Column:
    """As avro(), of proto text: package, the last (or first) message, imports as references."""
    lines = _lines(definition)
    names = F.filter(F.transform(_after(lines, "message"), _token), lambda x: x != "")
    imports = F.transform(_after(lines, "import"), lambda x: F.btrim(F.regexp_replace(x, r";\z", ""), F.lit('"')))
    package = F.transform(_after(lines, "package"), lambda x: F.regexp_replace(x, r";\z", ""))
    none = F.array().cast("array<struct<name:string,type:string,is_required:boolean,doc:string>>")
    return F.struct(F.try_element_at(names, F.lit(-1 if message == "last" else 1)).alias("record_name"), F.try_element_at(package, F.lit(-1)).alias("namespace"), F.lit(None).cast("string").alias("documentation"), none.alias("fields"), F.array_distinct(imports).alias("references"), F.lit(True).alias("ok"))


def first_text(definition: Column, key: str) -> Column:
    """The text after the first occurrence of a key, without parsing: a field's name counts if it stands first."""
    return F.regexp_extract(definition, rf'(?s)"{key}".[: "]*([^: "][^"]*)"', 1)


def light_metadata(definition: Column, data_format: Column) -> tuple[Column, Column]:
    """(record name, namespace), empty where not found, by plain text search: what naming relies on."""
    p = proto(definition, "first")
    name = F.when(data_format == "AVRO", first_text(definition, "name")).when(data_format == "JSON", first_text(definition, "title")).when(data_format == "PROTOBUF", p["record_name"])
    space = F.when(data_format == "AVRO", first_text(definition, "namespace")).when(data_format == "PROTOBUF", p["namespace"])
    return F.coalesce(name, F.lit("")), F.coalesce(space, F.lit(""))


def proto_assignments(definition: Column) -> Column:
    """The lines of proto text that assign something, comments and options left out."""
    return F.filter(_lines(definition), lambda x: x.contains("=") & ~x.startswith("//") & ~x.startswith("option"))
