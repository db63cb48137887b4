"""Social API entities: nested users are flattened, the others are renamed; and their load by a control list."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.cleanse import Rule, apply_rules
from tierflow.operators.nested import flatten
from tierflow.sources.files import read_json


@dataclass(frozen=True)
class Entity:
    """``nested`` decides between flattening and a plain copy."""

    name: str
    schema: str
    rules: tuple[Rule, ...]
    nested: tuple[tuple[str, str], ...] = ()
    multi_line: bool = False
    #: Columns the target table wants filled; the first rule's is its key.
    required: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return "id" if self.nested else self.rules[0].target


# Document schemas and the columns of the target tables.
USERS = Entity(
    "users",
    "address struct<city: string, geo: struct<lat: string, lng: string>, street: string, suite: string, "
    "zipcode: string>, company struct<bs: string, catchPhrase: string, name: string>, email string, "
    "id int, name string, phone string, username string, website string",
    rules=(
        Rule("id", "int"), Rule("name", "string"), Rule("username", "string"), Rule("email", "string"),
        Rule("phone", "string"), Rule("website", "string"), Rule("street", "string"), Rule("suite", "string"),
        Rule("city", "string"), Rule("zipcode", "string"), Rule("geoLat", "decimal(9,6)"),
        Rule("geoLng", "decimal(9,6)"), Rule("companyName", "string"), Rule("companyCatchPhrase", "string"),
        Rule("companyBs", "string"),
    ),
    nested=(
        ("address.geo.lat", "geoLat"), ("address.geo.lng", "geoLng"), ("address.street", "street"),
        ("address.city", "city"), ("address.suite", "suite"), ("phone", "phone"), ("username", "username"),
        ("address.zipcode", "zipcode"), ("website", "website"), ("company.name", "companyName"),
        ("company.catchPhrase", "companyCatchPhrase"), ("company.bs", "companyBs"), ("id", "id"),
        ("name", "name"), ("email", "email"),
    ),
    multi_line=True,
    required=("id",),
)
POSTS = Entity(
    "posts", "userId int, id int, title string, body string",
    rules=(Rule("PostID", "int", source="id"), Rule("UserID", "int", source="userId"),
           Rule("Title", "string", source="title"), Rule("Body", "string", source="body")),
    multi_line=True,
    required=("PostID", "UserID", "Title", "Body"),
)
COMMENTS = Entity(
    "comments", "postId int, id int, name string, email string, body string",
    rules=(Rule("CommentID", "int", source="id"), Rule("PostID", "int", source="postId"),
           Rule("CommenterName", "string", source="name"), Rule("CommenterEmail", "string", source="email"),
           Rule("Body", "string", source="body")),
    required=("CommentID", "PostID", "CommenterName", "CommenterEmail", "Body"),
)
ALBUMS = Entity(
    "albums", "userId int, id int, title string",
    rules=(Rule("AlbumID", "int", source="id"), Rule("UserID", "int", source="userId"),
           Rule("Title", "string", source="title")),
    required=("AlbumID", "UserID", "Title"),
)
PHOTOS = Entity(
    "photos", "albumId int, id int, title string, url string, thumbnailUrl string",
    rules=(Rule("PhotoID", "int", source="id"), Rule("AlbumID", "int", source="albumId"),
           Rule("Title", "string", source="title"), Rule("SourceURL", "string", source="url"),
           Rule("ThumbnailURL", "string", source="thumbnailUrl")),
    required=("PhotoID", "AlbumID", "Title", "SourceURL", "ThumbnailURL"),
)
TODOS = Entity(
    "todos", "userId int, id int, title string, completed boolean",
    rules=(Rule("TodoID", "int", source="id"), Rule("UserID", "int", source="userId"),
           Rule("Title", "string", source="title"), Rule("IsCompleted", "boolean", source="completed")),
    multi_line=True,
    required=("TodoID", "UserID", "Title", "IsCompleted"),
)
ENTITIES = {e.name: e for e in (POSTS, COMMENTS, USERS, ALBUMS, TODOS, PHOTOS)}


def to_table(documents: DataFrame, entity: Entity) -> DataFrame:
    """Flatten a nested entity, then rename and type the columns. No shuffle."""
    flat = flatten(documents, entity.nested) if entity.nested else documents
    return apply_rules(flat, entity.rules)


def read_entity(
    spark: SparkSession, path: str, entity: Entity, multi_line: bool | None = None, limit: int | None = None
) -> DataFrame:
    """Landed JSON of one entity as its table."""
    lines = entity.multi_line if multi_line is None else multi_line
    return to_table(read_json(spark, path, entity.schema, multi_line=lines, limit=limit), entity)


# --- load ---------------------------------------------------------------------------------

LOADED_AT = "IngestionTimestamp"


@dataclass(frozen=True)
class Control:
    """One row of the control list: what is landed where, how it is loaded, and into which table."""

    target_file: str
    target_table: str
    nested: bool = False


# The control list, in the order of the load.
CONTROLS = (
    Control("posts", "Gold_Social_Posts"), Control("comments", "Gold_Social_Comments"),
    Control("users", "Gold_Social_Users", nested=True), Control("albums", "Gold_Social_Albums"),
    Control("todos", "Gold_Social_Todos"), Control("photos", "Gold_Social_Photos"),
)


class LoadStopped(RuntimeError):
    """A load that stopped at its first error; ``loaded`` has the rows of the tables before."""

    def __init__(self, table: str, loaded: dict[str, int], cause: Exception):
        super().__init__(f"{table}: {cause}")
        self.table, self.loaded = table, loaded


def run_load(spark: SparkSession, landing: str, now: datetime, insert: Callable[[str, DataFrame, str, Sequence[str]], int],
             controls: Sequence[Control] = CONTROLS) -> dict[str, int]:
    """Load the landed documents of each control row into its table, in turn; returns the rows of each.

    A nested entity is flattened, any other is copied under its new names; each row gets the time of the load.
    ``insert(table, rows, key, required)`` appends rows, such as ``insert_rows``. The first error ends the load.
    """
    loaded: dict[str, int] = {}
    for control in controls:
        entity = ENTITIES[control.target_file]
        if control.nested != bool(entity.nested):
            raise ValueError(f"{control.target_file} is {'not ' if control.nested else ''}nested")
        try:
            rows = read_entity(spark, f"{landing}/{control.target_file}", entity).withColumn(LOADED_AT, F.lit(now))
            loaded[control.target_table] = insert(control.target_table, rows, entity.key, entity.required)
        except Exception as error:
            raise LoadStopped(control.target_table, loaded, error) from error
    return loaded
