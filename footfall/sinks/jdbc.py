"""Writing results to an external database.

Rows are loaded in parallel into a staging table of this call's own; one set-based statement list
then merges it into the target in a single transaction, and the staging table is dropped.
"""

import uuid

from footfall.sources.jdbc import jdbc_options

#: Connections a write opens at most, and rows sent in one round trip.
CONNECTIONS, BATCH_ROWS = 16, 5_000


def write_options(url, table, connections=CONNECTIONS, batch_rows=BATCH_ROWS, **options):
    """Writer options. However many partitions a result has, the database sees ``connections``."""
    return jdbc_options(url, table, **options) | {"numPartitions": str(connections), "batchsize": str(batch_rows)}


def append_jdbc(df, url, table, schema=None, **options):
    """Add rows to a database table in the sink's column order.

    A task that is tried again may add its rows twice; ``replace_task_jdbc`` does not.
    """
    rows = df.select(*schema.names) if schema else df
    rows.write.format("jdbc").options(**write_options(url, table, **options)).mode("append").save()


def quoted(name, dialect):
    """A column name as the dialect quotes it. Table names are taken as the caller writes them."""
    mark = "`" if dialect == "mysql" else '"'
    return mark + name.replace(mark, mark * 2) + mark


def merge_statements(table, staging, columns, keys, how, dialect="mysql"):
    """SQL that merges ``staging`` into ``table``.

    ``replace`` upserts by key, ``add`` upserts by key and adds to the values that are there,
    ``insert_new`` adds unknown keys only, ``replace_groups`` deletes every group present in staging
    and inserts its new rows. All but ``add`` end in the same table when they are repeated; ``merge_jdbc`` makes
    ``add`` repeatable by a ledger.
    """
    name = {c: quoted(c, dialect) for c in [*columns, *keys]}
    cols = ", ".join(name[c] for c in columns)
    source = ", ".join(f"s.{name[c]}" for c in columns)
    match = " AND ".join(f"t.{name[k]} = s.{name[k]}" for k in keys)
    values = [c for c in columns if c not in keys]
    unknown = (
        f"INSERT INTO {table} ({cols}) SELECT {source} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {match})"
    )
    if how == "insert_new":
        return [unknown]
    if how == "replace_groups":
        same = " AND ".join(f"{table}.{name[k]} = s.{name[k]}" for k in keys)
        return [
            f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {same})",
            f"INSERT INTO {table} ({cols}) SELECT {source} FROM {staging} s",
        ]
    if how not in ("replace", "add"):
        raise ValueError(f"unknown merge {how!r}")
    if not values:
        return [unknown]

    def changed(c):
        return f"COALESCE(t.{name[c]}, 0) + s.{name[c]}" if how == "add" else f"s.{name[c]}"

    if dialect == "mysql":
        sets = ", ".join(f"t.{name[c]} = {changed(c)}" for c in values)
        return [f"UPDATE {table} t JOIN {staging} s ON {match} SET {sets}", unknown]
    sets = ", ".join(f"{name[c]} = {changed(c)}" for c in values)
    return [
        f"MERGE INTO {table} t USING {staging} s ON {match} "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({source})"
    ]


def replace_task_statements(table, staging, columns, task_id, dialect="mysql"):
    """SQL that puts ``staging`` in the place of all rows of one task, also where it is empty."""
    cols = ", ".join(quoted(c, dialect) for c in columns)
    return [
        f"DELETE FROM {table} WHERE {quoted('task_id', dialect)} = {int(task_id)}",
        f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}",
    ]


def staging_name(table):
    """A staging table no other call uses, so that jobs running side by side keep their rows apart."""
    return f"{table}_staging_{uuid.uuid4().hex[:12]}"


def ledger_statement(ledger, delivery):
    """SQL that enters ``delivery`` (query name, batch number) in the ledger, and changes no row if it is there.

    The ledger needs a primary key over both columns: of two deliveries at once the second then fails.
    """
    query, batch_id = delivery
    name, number = "'" + query.replace("'", "''") + "'", int(batch_id)
    return (
        f"INSERT INTO {ledger} (query_name, batch_id) SELECT {name}, {number} FROM (SELECT 1 AS one_row) o "
        f"WHERE NOT EXISTS (SELECT 1 FROM {ledger} l WHERE l.query_name = {name} AND l.batch_id = {number})"
    )


def merge_jdbc(df, url, table, keys, how="replace", dialect="mysql", delivery=None, ledger="delivered_batches", **options):
    """Merge ``df`` into a database table by ``keys``.

    ``delivery`` (query name, batch number) is entered in ``ledger`` in the transaction of the merge. A delivery that
    is entered already changes nothing, so a micro-batch may be sent again whatever ``how`` is.
    """
    guard = ledger_statement(ledger, delivery) if delivery else None
    _through_staging(
        df, url, table, lambda staging: merge_statements(table, staging, df.columns, keys, how, dialect), guard, **options
    )


def publisher(url, plans, dialect="mysql", **options):
    """A ``publish(table, rows, batch_id)`` for the live statistics: ``plans`` maps tables to (keys, how)."""

    def publish(table, rows, batch_id):
        keys, how = plans[table]
        merge_jdbc(rows, url, table, keys, how, dialect, (table, batch_id), **options)

    return publish


def replace_task_jdbc(df, url, table, task_id, dialect="mysql", **options):
    """Make ``df`` the rows of task ``task_id``; running the task again leaves no row twice."""
    _through_staging(
        df, url, table, lambda staging: replace_task_statements(table, staging, df.columns, task_id, dialect), None, **options
    )


def _through_staging(df, url, table, statements, guard, user=None, password=None, **options):
    staging = staging_name(table)
    load = write_options(url, staging, user=user, password=password, **options)
    manager = df.sparkSession._jvm.java.sql.DriverManager
    try:
        df.write.format("jdbc").options(**load).mode("overwrite").save()
        _execute(manager, url, user, password, statements(staging), guard)
    finally:
        _execute(manager, url, user, password, [f"DROP TABLE IF EXISTS {staging}"])


def _execute(manager, url, user, password, statements, guard=None):
    """Run the statements in one transaction, or none of them if ``guard`` runs first and changes no row."""
    connection = manager.getConnection(url, user, password) if user else manager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        if guard is None or statement.executeUpdate(guard):
            for sql in statements:
                statement.executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
