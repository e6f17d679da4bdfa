"""What the session knows about itself, as literal columns.

Region, account, role, warehouse and statement have no counterpart in Spark: they come from the settings
skein.region, skein.account, ... and are null where unset.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _setting(name: str) -> Column:
    return F.lit(SparkSession.active().conf.get(f"skein.{name}", None)).cast("string")


def current_region() -> Column:
    return _setting("region")


def current_version() -> Column:
    return F.lit(SparkSession.active().version)


def current_account() -> Column:
    return _setting("account")


def current_role() -> Column:
    return _setting("role")


def current_available_roles() -> Column:
    return _setting("available_roles")


def current_session() -> Column:
    return F.lit(SparkSession.active().sparkContext.applicationId)


def current_statement() -> Column:
    return _setting("statement")


def current_user() -> Column:
    return F.current_user()


def current_database() -> Column:
    return F.current_catalog()


def current_schema() -> Column:
    return F.current_schema()


def current_schemas() -> Column:
    return F.lit(json.dumps(sorted(d.name for d in SparkSession.active().catalog.listDatabases())))


def current_warehouse() -> Column:
    return _setting("warehouse")
