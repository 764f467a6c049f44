"""Data products: seeds, sources and models published under one namespace.

A model is a function that returns a DataFrame, or SQL text. The product builds
seeds and models in the order of their references; every model is an ordinary
Spark plan, published as a view or as a Parquet table.
"""

from __future__ import annotations

import graphlib
import posixpath
import re
import string
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sparkmart.operators.contract import Contract, enforce
from sparkmart.operators.policy import ColumnMask, Identity, RowFilter, TableName, secure
from sparkmart.plans.governed import governed_query
from sparkmart.plans.inherited import CannotCarry, carry
from sparkmart.plans.lineage import Lineage, lineage
from sparkmart.sources.delimited import read_seed
from sparkmart.sources.tables import (
    SourceTable,
    finish_publishing,
    publish_all,
    remove_superseded,
    store_version,
    store_view_version,
)
from sparkmart.workspace import shared_folder

Version = str | float | int | None

SESSION_CATALOG = "spark_catalog"


def _text(version: Version) -> str | None:
    """Versions are told apart by their text, so 1.0 and "1.0" are one version."""
    return None if version is None else str(version)


def relation_name(name: str, alias: str | None = None, version: Version = None) -> str:
    """The published name: alias or model name, with ``_v<version>`` if versioned."""
    base = (alias or "").strip() or name
    if not version:
        return base
    return f"{base}_v{str(version).replace('.', '_')}"


def _lineage_name(table: TableName) -> str:
    return f"{table.catalog}.{table.schema}.{table.table}".lower()


def _names_in(text: str) -> set[str]:
    """The names that SQL text has in braces; doubled braces stand for themselves."""
    names = {name for _, name, _, _ in string.Formatter().parse(text) if name is not None}
    odd = sorted(name for name in names if not re.fullmatch(r"\w+", name))
    if odd:
        raise ValueError(f"braces hold names only, not {odd}; write a plain brace twice")
    return names


@dataclass(frozen=True)
class Model:
    name: str
    body: Callable[[ModelContext], DataFrame] | str
    refs: tuple[tuple[str, str | None], ...]
    materialized: str
    alias: str | None
    version: Version
    contract: Contract | None
    meta: Mapping[str, str]
    description: str | None

    @property
    def relation(self) -> str:
        return relation_name(self.name, self.alias, self.version)

    @property
    def for_session(self) -> bool:
        """A view of a function cannot be stored and lasts as long as the session."""
        return self.materialized == "view" and not isinstance(self.body, str)

    @property
    def tags(self) -> dict[str, str]:
        tags = {f"meta.{tag}": value for tag, value in self.meta.items()}
        return tags | ({"description": self.description} if self.description else {})


@dataclass
class ModelContext:
    """What a model function sees: its declared references and the sources."""

    product: Product
    model: Model

    @property
    def spark(self) -> SparkSession:
        return self.product.spark

    def ref(self, name: str, version: Version = None) -> DataFrame:
        if (name, _text(version)) not in self.model.refs:
            raise KeyError(f"model {self.model.name!r} does not declare a reference to {name!r}")
        return self.product.ref(name, version)

    def source(self, name: str) -> DataFrame:
        return self.product.source(name)


@dataclass
class GovernedContext(ModelContext):
    """What a model function sees when it is planned for one reader."""

    identity: Identity | None = None

    def ref(self, name: str, version: Version = None) -> DataFrame:
        if (name, _text(version)) not in self.model.refs:
            raise KeyError(f"model {self.model.name!r} does not declare a reference to {name!r}")
        return self.product.read(name, self.identity, version)

    def source(self, name: str) -> DataFrame:
        return self.product.read_source(name, self.identity)


@dataclass
class Product:
    """Models under ``catalog.schema``; the same models fit any namespace.

    Models are published in the session's own catalog, whose tables can be pointed at new files;
    another catalog is refused here. Sources may come from any catalog.
    """

    spark: SparkSession
    schema: str
    catalog: str = SESSION_CATALOG
    root: str | None = None
    policies: list[RowFilter | ColumnMask] = field(default_factory=list)
    #: Whether policies on seeds, sources and models reach the models above them. Else a model
    #: is read with its owner's rights, and needs policies of its own.
    follow: bool = False

    def __post_init__(self) -> None:
        if self.catalog != SESSION_CATALOG:
            raise ValueError(f"models are published in {SESSION_CATALOG}, not in {self.catalog!r}")
        base = self.root or f"{shared_folder(self.spark)}/sparkmart/products"
        self.root = f"{base.rstrip('/')}/{self.catalog}/{self.schema}"
        self._models: dict[tuple[str, str | None], Model] = {}
        self._latest: dict[str, str | None] = {}
        self._seeds: dict[str, DataFrame | Callable[[SparkSession], DataFrame]] = {}
        self._sources: dict[str, SourceTable] = {}
        self._built: dict[tuple[str, str | None], str] = {}
        self._building = False
        self._lineage: dict[tuple[str, str | None], Lineage] = {}

    # Declarations

    def seed(self, name: str, rows: DataFrame | Callable[[SparkSession], DataFrame]) -> None:
        """A small table loaded before all models, named after itself."""
        self._refuse_taken(name, None)
        self._seeds[name] = rows

    def seed_file(self, path: str, schema: T.StructType | None = None) -> str:
        """A headered CSV file as a seed named after the file; gives that name."""
        name = posixpath.splitext(posixpath.basename(path.rstrip("/")))[0]
        self.seed(name, lambda spark: read_seed(spark, path, schema))
        return name

    def declare_source(self, name: str, table: SourceTable) -> None:
        self._sources[name] = table

    def model(
        self,
        name: str,
        *,
        refs: Iterable[str | tuple[str, Version]] = (),
        materialized: str = "view",
        alias: str | None = None,
        version: Version = None,
        latest: bool = False,
        contract: Contract | None = None,
        meta: Mapping[str, str] | None = None,
        description: str | None = None,
        sql: str | None = None,
    ):
        """Declare a model: as a decorator of its function, or with its SQL text.

        SQL text names its references in braces, such as ``select * from {orders}``; they
        need not be repeated in ``refs``. A brace that is meant as such is written twice.
        SQL views are stored in the catalog; views of functions last as long as the
        session. The newest version answers references without a version, unless
        another one is declared ``latest``.
        """
        if materialized not in ("view", "table"):
            raise ValueError(f"materialized is 'view' or 'table', not {materialized!r}")
        if sql is not None:
            _names_in(sql)

        def declare(body):
            self._refuse_taken(name, version)
            pairs = tuple((r, None) if isinstance(r, str) else (r[0], _text(r[1])) for r in refs)
            declared = Model(
                name,
                body,
                pairs,
                materialized,
                alias,
                version,
                contract,
                dict(meta or {}),
                description,
            )
            taken = [m for m in self._models.values() if m.relation == declared.relation]
            if taken or declared.relation in self._seeds:
                raise ValueError(f"relation {declared.relation!r} is declared twice")
            self._models[(name, _text(version))] = declared
            if latest:
                self._latest[name] = _text(version)
            return body

        return declare if sql is None else declare(sql)

    def _refuse_taken(self, name: str, version: Version) -> None:
        versions = [v for n, v in self._models if n == name]
        if name in self._seeds or _text(version) in versions:
            raise ValueError(f"{name!r} is declared twice")
        if versions and (version is None or None in versions):
            raise ValueError(f"{name!r} has versions, so each needs one")

    # Names

    def latest_version(self, name: str) -> str | None:
        if name in self._latest:
            return self._latest[name]
        versions = [version for declared, version in self._models if declared == name]
        if not versions and name not in self._seeds:
            raise KeyError(f"no model or seed named {name!r}")
        if len(versions) < 2:
            return versions[0] if versions else None
        return max(versions, key=lambda v: [int(part) for part in v.split(".")])

    def _key(self, name: str, version: Version = None) -> tuple[str, str | None]:
        key = (name, self.latest_version(name) if version is None else _text(version))
        if key not in self._models and name not in self._seeds:
            raise KeyError(f"no version {version!r} of {name!r}")
        return key

    def _qualified(self, relation: str) -> str:
        return f"`{self.catalog}`.`{self.schema}`.`{relation}`"

    def _relation_of(self, key: tuple[str, str | None]) -> str:
        return self._models[key].relation if key in self._models else key[0]

    # Reading

    def ref(self, name: str, version: Version = None) -> DataFrame:
        """A built seed or model; without a version, its latest one."""
        key = self._key(name, version)
        if key not in self._built:
            raise LookupError(f"{name!r} is not built yet")
        model = self._models.get(key)
        if model and model.for_session:
            if not self._building:
                # A function's plan may hold choices by size, so each read plans anew.
                self._built[key] = self._build_model(model)
        return self.spark.table(self._built[key])

    def source(self, name: str) -> DataFrame:
        return self._sources[name].read(self.spark)

    def read(self, name: str, identity: Identity | None, version: Version = None) -> DataFrame:
        """A built relation as ``identity`` may see it under the product's policies."""
        return self._governed(self._key(name, version), identity)

    def read_source(self, name: str, identity: Identity | None) -> DataFrame:
        """A source as ``identity`` may see it."""
        source = self._sources[name]
        table = TableName(source.catalog or self.catalog, source.schema, source.table)
        return secure(self.source(name), table, identity, self.policies)

    def sql(self, text: str, identity: Identity | None = None) -> DataFrame:
        """Query built relations and sources, each named in braces, as ``identity``.

        The text must be a query, and its resolved plan may read nothing else: a command, or
        a table reached in any other way, raises ``PermissionError`` and changes nothing.
        """
        by_relation = {self._relation_of(key): key for key in self._built}
        frames = {}
        for name in _names_in(text):
            if name in by_relation:
                frames[name] = self._governed(by_relation[name], identity)
            elif name in self._sources:
                frames[name] = self.read_source(name, identity)
            else:
                frames[name] = self.read(name, identity)
        return governed_query(self.spark, text, frames)

    def _table_name(self, key: tuple[str, str | None]) -> TableName:
        return TableName(self.catalog, self.schema, self._relation_of(key))

    def _governed(self, key: tuple[str, str | None], identity: Identity | None) -> DataFrame:
        rows = self.ref(*key)
        if self.follow and key in self._models:
            try:
                rows = carry(rows, self._lineage_of(key), self._active(identity))
            except CannotCarry:
                rows = self._planned_for(key, identity)
        return secure(rows, self._table_name(key), identity, self.policies)

    def _active(self, identity: Identity | None) -> dict[str, list[RowFilter | ColumnMask]]:
        """The policies that apply to ``identity``, by the relation's name in lineages."""
        user = identity.user if identity else None
        active: dict[str, list[RowFilter | ColumnMask]] = {}
        for policy in self.policies:
            if user is None or user not in policy.exempt:
                active.setdefault(_lineage_name(policy.table), []).append(policy)
        return active

    def _planned_for(self, key: tuple[str, str | None], identity: Identity | None) -> DataFrame:
        """The model's rows made anew from what ``identity`` may see of the relations it reads."""
        model = self._models[key]
        if isinstance(model.body, str):
            by_relation = {self._relation_of(built): built for built in self._built}
            frames = {
                name: self._governed(by_relation[name], identity)
                if name in by_relation
                else self.read_source(name, identity)
                if name in self._sources
                else self.read(name, identity)
                for name in _names_in(model.body)
            }
            rows = governed_query(self.spark, model.body, frames)
        else:
            rows = model.body(GovernedContext(self, model, identity))
        return rows if model.contract is None else enforce(rows, model.contract)

    def _lineage_of(self, key: tuple[str, str | None]) -> Lineage:
        """A built model's lineage, from its own plan and those of the models it reads."""
        if key not in self._lineage:
            model = self._models[key]
            graph = [self._key(*reference) for reference in model.refs]
            if isinstance(model.body, str):
                graph += self._text_references(model)
                rows = self.spark.sql(model.body.format_map(self._placeholders()))
            else:
                rows = model.body(ModelContext(self, model))
            above = {
                _lineage_name(self._table_name(read)): self._lineage_of(read)
                for read in graph
                if read in self._models
            }
            self._lineage[key] = lineage(rows, self._relation_at, above)
        return self._lineage[key]

    def _relation_at(self, node) -> str | None:
        """The name in lineages of the relation that a plan's node reads: a built one or a table."""
        kind = node.nodeName()
        if kind == "View":
            found = node.desc().identifier()
        elif kind.startswith(("Relation", "LogicalRelation", "HiveTableRelation")) and (
            node.catalogTable().isDefined()
        ):
            found = node.catalogTable().get().identifier()
        else:
            return None
        parts = [found.catalog(), found.database()]
        catalog, schema = [part.get() if part.isDefined() else "" for part in parts]
        session = {f"{self.catalog}__{self.schema}__{self._relation_of(key)}": key for key in self._built}
        if not schema and found.table() in session:
            return _lineage_name(self._table_name(session[found.table()]))
        return _lineage_name(TableName(catalog or self.catalog, schema, found.table()))

    def _placeholders(self) -> dict[str, str]:
        """What SQL models may name in braces: sources, relations, latest versions."""
        names = {name: table.full_name for name, table in self._sources.items()}
        for name, version in self._built:
            latest = self._built.get(self._key(name))
            if latest:
                names[name] = latest
        for key, stored in self._built.items():
            names[self._relation_of(key)] = stored
        return names

    def relations(self, **meta: str) -> dict[str, Model]:
        """Published relation -> model, for all models whose tags include ``meta``."""
        return {
            model.relation: model
            for model in self._models.values()
            if all(model.meta.get(tag) == value for tag, value in meta.items())
        }

    def output_ports(self) -> dict[str, Model]:
        return self.relations(output_port="true")

    def published_ports(self) -> list[str]:
        """Output ports by the tags in the catalog, so another session sees them as well. A
        view of a function is not stored and so not listed."""
        listed = self.spark.catalog.listTables(f"`{self.catalog}`.`{self.schema}`")
        names = sorted(table.name for table in listed if not table.isTemporary)
        ports = []
        for name in names:
            tags = self.spark.sql(f"SHOW TBLPROPERTIES {self._qualified(name)}")
            if not tags.where("key = 'meta.output_port' AND value = 'true'").isEmpty():
                ports.append(name)
        return ports

    def remove_superseded(self) -> list[str]:
        """Drop versions of earlier builds that no relation points at, and give their folders.

        Call it when no reader of an earlier build is left.
        """
        removed = []
        for key, name in self._built.items():
            if key not in self._models or not self._models[key].for_session:
                removed += remove_superseded(self.spark, name, self.root)
        return removed

    # Building

    def build_order(self) -> list[tuple[str, str | None]]:
        """Seeds and models, each after what it refers to. A cycle raises."""
        graph: dict[tuple[str, str | None], list] = {(name, None): [] for name in self._seeds}
        for key, model in self._models.items():
            graph[key] = [self._key(*reference) for reference in model.refs]
            if isinstance(model.body, str):
                graph[key] += self._text_references(model)
        return list(graphlib.TopologicalSorter(graph).static_order())

    def _text_references(self, model: Model) -> list[tuple[str, str | None]]:
        """The seeds and models that a model's SQL text names in braces."""
        by_relation = {declared.relation: key for key, declared in self._models.items()}
        names = _names_in(model.body) - set(self._sources)
        return [by_relation[name] if name in by_relation else self._key(name) for name in names]

    def build(self) -> dict[str, DataFrame]:
        """Load the seeds, build every model, and return all relations by name.

        Everything is made as versions first, each model over the versions of what it refers to,
        and then published at once: a failure in any model leaves all relations as they were.
        """
        order = self.build_order()
        self.spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS `{self.catalog}`.`{self.schema}` "
            f"LOCATION '{self.root}'"
        )
        self.recover()
        before, self._built = self._built, {}
        self._lineage.clear()
        self._building = True
        found: dict[str, tuple[str, dict]] = {}
        try:
            for key in order:
                model = self._models.get(key)
                if model is None:
                    rows = self._seeds[key[0]]
                    rows = rows(self.spark) if callable(rows) else rows
                    self._built[key] = store_version(rows, self._qualified(key[0]), self.root)
                else:
                    self._built[key] = self._build_model(model)
                if model is None or not model.for_session:
                    name = self._qualified(self._relation_of(key))
                    found[name] = self._built[key], model.tags if model else {}
            publish_all(self.spark, f"`{self.catalog}`.`{self.schema}`", found)
        except BaseException:
            self._built = before
            raise
        finally:
            self._building = False
        for key in order:
            if key not in self._models or not self._models[key].for_session:
                self._built[key] = self._qualified(self._relation_of(key))
        return {self._relation_of(key): self.spark.table(name) for key, name in self._built.items()}

    def recover(self) -> list[str]:
        """Publish what a build had begun to publish when its driver was lost; gives the tables."""
        return finish_publishing(self.spark, f"`{self.catalog}`.`{self.schema}`")

    def _build_model(self, model: Model) -> str:
        """Make a version of a model, or a session's view of a function, and give its name."""
        if isinstance(model.body, str):
            text = model.body.format_map(self._placeholders())
            rows = self.spark.sql(text)
        else:
            rows = model.body(ModelContext(self, model))
        if model.contract is not None:
            rows = enforce(rows, model.contract)
        name = self._qualified(model.relation)
        if model.materialized == "table":
            return store_version(rows, name, self.root)
        if isinstance(model.body, str):
            return store_view_version(rows, text, name)
        view = f"{self.catalog}__{self.schema}__{model.relation}"
        rows.createOrReplaceTempView(view)
        return f"`{view}`"
