"""Social entities landed as JSON arrays or lines, read back as tables, and loaded by the control list."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from tierflow.catalog.registry import Tables, query
from tierflow.plans import social
from tierflow.sinks.files import has_files, insert_rows, write_json_lines

RAW = {
    "users": """
        select c_custkey id, c_name name, lower(c_mktsegment) username, concat(c_name, '@example.org') email,
               named_struct('street', concat(c_custkey, ' "Main" Street'), 'suite', concat('Apt. ', c_nationkey),
                 'city', n_name, 'zipcode', cast(c_nationkey as string),
                 'geo', named_struct('lat', cast(c_acctbal / 100 as string),
                                     'lng', cast(-c_nationkey as string))) address,
               concat('1-', c_custkey) phone, concat(n_name, '.example') website,
               named_struct('name', r_name, 'catchPhrase', c_mktsegment, 'bs', cast(null as string)) company
        from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "posts": "select cast(n_chars as int) userId, cast(doc_id as int) id, source title, text body from {documents}",
    "comments": """
        select cast(conv_id as int) postId, cast(conv_id * 1000 + turn as int) id, role name,
               concat(role, '@example.org') email, text body from {conversations}""",
    "albums": "select cast(page_id * 2 as int) userId, cast(page_id as int) id, url title from {pages}",
    "photos": """
        select cast(page_id * 3 as int) albumId, cast(page_id as int) id, html title, url,
               concat(url, '#small') thumbnailUrl from {pages}""",
    "todos": """
        select cast(doc_id as int) userId, cast(doc_id as int) id, concat('label ', doc_id) title,
               quality = 1 completed from {labels}""",
}


def land_array(rows, path: str) -> None:
    """Files that each hold one array, with a byte-order mark in front: one from each task, so no task writes them all."""
    def as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "\ufeff[\n"
        for batch in batches:
            lines = []
            for text in batch.column(0).to_pylist():
                lines.append(before + text)
                before = ","
            yield pa.record_batch({"value": pa.array(lines, pa.string())})
        yield pa.record_batch({"value": pa.array(["]" if before == "," else "[]"], pa.string())})

    text = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    text.mapInArrow(as_array, "value string").write.text(path)


def land(t: Tables, name: str) -> str:
    """Documents of one entity: one array, or a line for each."""
    path = f"{t.scratch}/{name}"
    if social.ENTITIES[name].multi_line:
        land_array(t.sql(RAW[name]), path)
    else:
        write_json_lines(t.sql(RAW[name]), path)
    return path


def landed(t: Tables, name: str):
    return social.read_entity(t.spark, land(t, name), social.ENTITIES[name])


@query("social_users", """
    select c_custkey id, c_name name, lower(c_mktsegment) username, c_name || '@example.org' email,
           '1-' || c_custkey phone, n_name || '.example' website, c_custkey || ' "Main" Street' street,
           'Apt. ' || c_nationkey suite, n_name city, cast(c_nationkey as varchar) zipcode,
           cast(cast(c_acctbal / 100 as decimal(9,6)) as double) "geoLat",
           cast(-c_nationkey as double) "geoLng", r_name "companyName", c_mktsegment "companyCatchPhrase",
           cast(null as varchar) "companyBs"
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def social_users(t: Tables):
    return landed(t, "users")


@query("social_posts", """
    select doc_id "PostID", n_chars "UserID", source "Title", text "Body" from documents""")
def social_posts(t: Tables):
    return landed(t, "posts")


@query("social_comments", """
    select conv_id * 1000 + turn "CommentID", conv_id "PostID", role "CommenterName",
           role || '@example.org' "CommenterEmail", text "Body" from conversations""")
def social_comments(t: Tables):
    return landed(t, "comments")


@query("social_albums", """select page_id "AlbumID", page_id * 2 "UserID", url "Title" from pages""")
def social_albums(t: Tables):
    return landed(t, "albums")


@query("social_photos", """
    select page_id "PhotoID", page_id * 3 "AlbumID", html "Title", url "SourceURL",
           url || '#small' "ThumbnailURL" from pages""")
def social_photos(t: Tables):
    return landed(t, "photos")


@query("social_todos", """
    select doc_id "TodoID", doc_id "UserID", 'label ' || doc_id "Title", quality = 1 "IsCompleted" from labels""")
def social_todos(t: Tables):
    return landed(t, "todos")


# --- the load as a whole ------------------------------------------------------------------

_LOAD_TIME = datetime(2026, 6, 19, 18, 41)


def _run(t: Tables, **changed) -> tuple[str, social.LoadStopped | None]:
    """Land all entities, ``changed`` ones as given, and load them; the folder of the tables, and what stopped the load."""
    for control in social.CONTROLS:
        name = control.target_file
        if name in changed:
            write_json_lines(changed[name], f"{t.scratch}/{name}")
        else:
            land(t, name)
    tables = f"{t.scratch}/tables"
    try:
        social.run_load(t.spark, t.scratch, _LOAD_TIME,
                        lambda table, rows, key, required: insert_rows(rows, f"{tables}/{table}", key, required))
    except social.LoadStopped as stopped:
        return tables, stopped
    return tables, None


def _report(t: Tables, tables: str):
    """Rows of each table and the time they were loaded at."""
    out = None
    for control in social.CONTROLS:
        entity, path = social.ENTITIES[control.target_file], f"{tables}/{control.target_table}"
        if has_files(t.spark, path):
            rows = t.spark.read.parquet(path).agg(
                F.lit(control.target_table).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                F.count_distinct(entity.key).alias("keys"), F.min(social.LOADED_AT).cast("string").alias("loaded_at"))
            out = rows if out is None else out.union(rows)
    return out


_COUNTS = {
    "Posts": "count(*), count(distinct doc_id) from documents", "Comments": "count(*), count(distinct conv_id * 1000 + turn) from conversations",
    "Users": "count(*), count(distinct c_custkey) from customer", "Albums": "count(*), count(distinct page_id) from pages",
    "Todos": "count(*), count(distinct doc_id) from labels", "Photos": "count(*), count(distinct page_id) from pages",
}


def _counts(*names: str) -> str:
    return " union all ".join(
        f"select 'Gold_Social_{n}' as table_name, rows, keys, '2026-06-19 18:41:00' as loaded_at "
        f"from (select {_COUNTS[n].replace(', ', ' as rows, ', 1).replace(' from', ' as keys from', 1)})" for n in names)


@query("run_social_loaded", _counts(*_COUNTS))
def run_social_loaded(t: Tables):
    """All six entities by the control list: users flattened, the others copied."""
    tables, stopped = _run(t)
    if stopped:
        raise stopped
    return _report(t, tables)


@query("run_social_users", """
    select c_custkey id, c_name name, n_name city, cast(cast(c_acctbal / 100 as decimal(9,6)) as double) "geoLat",
           r_name "companyName", '2026-06-19 18:41:00' loaded_at
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def run_social_users(t: Tables):
    """The table of the nested entity after the load."""
    tables, _ = _run(t)
    return t.spark.read.parquet(f"{tables}/Gold_Social_Users").select(
        "id", "name", "city", "geoLat", "companyName", F.col(social.LOADED_AT).cast("string").alias("loaded_at"))


@query("run_social_stopped", f"select *, 'Gold_Social_Albums' as stopped_at from ({_counts('Posts', 'Comments', 'Users')})")
def run_social_stopped(t: Tables):
    """Albums without a title end the load: the tables before are there, it and those after are not."""
    albums = t.sql(RAW["albums"]).withColumn("title", F.when(F.col("id") % 7 > 0, F.col("title")))
    tables, stopped = _run(t, albums=albums)
    return _report(t, tables).withColumn("stopped_at", F.lit(stopped.table if stopped else None))
