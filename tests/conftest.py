import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from schemaloom.session import local_session  # noqa: E402

#: The catalog's tables; `bucket`, `key2`, `slice`, `line` and the like are extra columns that operators must not trip over.
DDL = {
    "registries": "name string, arn string, description string, tags map<string,string>, created_time timestamp, updated_time timestamp",
    "glue_schemas": "registry_name string, name string, arn string, description string, data_format string, compatibility string, tags map<string,string>, latest_version bigint, created_time timestamp, updated_time timestamp, bucket string, source string",
    "glue_versions": "registry_name string, schema_name string, version_number bigint, schema_version_id string, definition string, status string, created_time timestamp, ingested_at timestamp, id string, text string, slice int, field_path string",
    "parsed_schemas": "registry_name string, name string, record_name string, namespace string, documentation string, fields array<struct<name:string,type:string,is_required:boolean,doc:string>>, references array<string>, parsed_at timestamp, key string, parent string",
    "mappings": "source_registry string, source_schema_name string, source_versions int, target_context string, target_subject string, detected_role string, naming_strategy string, naming_reason string, transformations array<string>, references array<string>, dependency_level int, status string, warning string, error string, key string",
    "completed": "key string, source_registry string, source_schema string, target_subject string, versions int, completed_at timestamp",
    "subjects": "name string, context string, compatibility string, schema_type string, versions array<struct<version:int,schema_id:int,schema:string,schema_type:string,references:array<struct<name:string,subject:string,version:int>>>>, metadata struct<properties:map<string,string>,tags:array<string>>, n_versions int, side int",
    "requests": "request_id string, context string, subject string, schema string, schema_type string, references array<struct<name:string,subject:string,version:int>>, attempt int, requested_at timestamp, born timestamp, id string, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, page_id bigint, title string, ns int, rev_time timestamp, editor string, edit_note string, word string, line string, id string",
    "eval_items": "item_id bigint, suite string, text string, doc_id bigint",
}


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 2, "tests")
    yield s
    s.stop()


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables from lists of dicts (absent columns are null) and returns their folder; unnamed tables are empty."""

    def write(**rows) -> str:
        for name, ddl in DDL.items():
            df = spark.createDataFrame([], ddl)
            if rows.get(name):
                df = spark.createDataFrame([tuple(r.get(f.name) for f in df.schema) for r in rows[name]], df.schema)
            df.coalesce(2).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
