"""References that do not resolve: detection, priority exclusion, reason catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clean import DIGITS, blank, empty_to_null
from ..schemas import QUARANTINE, REQUIRED
from ..sources.layers import issue_rows, upsert
from .skew import any_of, explode_hits, lookup_join

PARENT_KEYS = ("source_account_id", "destination_account_id", "merchant_id", "agency_id")


def numeric_id(c: Column | str) -> Column:
    """All-digit text as bigint; anything else has no id and is not looked up."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(DIGITS), c.try_cast("bigint"))


def known_ids(parent: DataFrame) -> DataFrame:
    """Distinct parent ids: DF[key, hit]."""
    return (
        parent.select(F.col("id").alias("key"))
        .where(F.col("key").isNotNull())
        .distinct()
        .withColumn("hit", F.lit(True))
    )


def known_accounts(accounts: DataFrame, core_accounts: DataFrame) -> DataFrame:
    """Staged account ids with a marker for those that reached core: DF[key, hit, core].
    Joining the two account tables first saves a join of the transactions per side."""
    staged = known_ids(accounts).withColumn("number", numeric_id("key"))
    core = known_ids(core_accounts).select(F.col("key").alias("core_key"), F.lit(True).alias("core"))
    return staged.join(core, F.col("number") == F.col("core_key"), "left").select("key", "hit", "core")


def with_match(
    tx: DataFrame, column: str, known: DataFrame, name: str, numeric: bool,
) -> DataFrame:
    """Look a reference up among known keys and add the markers as ``<name>_<marker>``:
    true where the parent was found, else NULL. Blank references become NULL keys before
    the join, so they never meet in one partition."""
    key = numeric_id(column) if numeric else empty_to_null(column)
    keyed = tx.withColumn(f"{name}_ref", key)
    side = known.select(*[F.col(c).alias(f"{name}_{c}") for c in known.columns])
    joined = lookup_join(keyed, side, f"{name}_ref", f"{name}_key", "left")
    return joined.drop(f"{name}_ref", f"{name}_key")


def unresolved(column: str, name: str) -> Column:
    """The reference is blank, or no parent row was found."""
    return blank(column) | F.col(f"{name}_hit").isNull()


def dangling(column: str, marker: str) -> Column:
    """The reference is a number and no parent row was found; other text is skipped."""
    return F.col(marker).isNull() & F.coalesce(F.col(column).rlike(DIGITS), F.lit(False))


def missing_merchant_test() -> Column:
    return F.coalesce(F.col("transaction_type") == "PAY", F.lit(False)) & blank("merchant_id")


def _issues(hits: DataFrame, reason: str) -> DataFrame:
    return issue_rows(hits, reason, QUARANTINE[reason], "reject")


def _source_columns(df: DataFrame, tx: DataFrame) -> DataFrame:
    return df.select(*tx.columns)


def missing_source_account(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """Source account blank or not among the staged accounts."""
    hits = with_match(tx, "source_account_id", known_ids(accounts), "src", False).where(
        unresolved("source_account_id", "src"))
    return _issues(_source_columns(hits, tx), "missing_source_account")


def missing_destination_account(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """Destination account blank or unknown; applies to every transaction type."""
    hits = with_match(tx, "destination_account_id", known_ids(accounts), "dst", False).where(
        unresolved("destination_account_id", "dst"))
    return _issues(_source_columns(hits, tx), "missing_destination_account")


def missing_merchant(tx: DataFrame) -> DataFrame:
    """A payment without a merchant."""
    return _issues(tx.where(missing_merchant_test()), "missing_merchant")


def missing_core_reference(
    tx: DataFrame, accounts: DataFrame, merchants: DataFrame, agencies: DataFrame
) -> DataFrame:
    """A numeric reference whose parent did not reach core; four parents."""
    parents = (accounts, accounts, merchants, agencies)
    flagged, broken = tx, F.lit(False)
    for column, parent in zip(PARENT_KEYS, parents):
        flagged = with_match(flagged, column, known_ids(parent), f"core_{column}", True)
        broken = broken | dangling(column, f"core_{column}_hit")
    return _issues(_source_columns(flagged.where(broken), tx), "missing_core_reference")


def exclude(
    issues: DataFrame, *earlier: DataFrame, id: str = "staging_transaction_id",
) -> DataFrame:
    """Drop rows whose transaction is already in an earlier issue table.

    Ids of all earlier tables form one distinct set and one anti join. Rows without an
    id stay, whatever the earlier tables hold.
    """
    ids = None
    for frame in earlier:
        part = frame.select(F.col("staging_transaction_id").alias("_seen")).where(
            F.col("_seen").isNotNull())
        ids = part if ids is None else ids.unionByName(part)
    if ids is None:
        return issues
    return lookup_join(issues, ids.distinct(), id, "_seen", "left_anti")


HOLD_COLUMNS = ("id", "transaction_type", *PARENT_KEYS)


def with_holds(
    rows: DataFrame, account_ids: DataFrame, merchant_ids: DataFrame, agency_ids: DataFrame,
) -> DataFrame:
    """Add one boolean per quarantine reason, priorities aside; four lookups in all.

    An account that is not staged at all is a missing account; that reason comes before
    the core reference, so one account lookup per side serves both.
    """
    df = with_match(rows, "source_account_id", account_ids, "src", False)
    df = with_match(df, "destination_account_id", account_ids, "dst", False)
    df = with_match(df, "merchant_id", merchant_ids, "merchant", True)
    df = with_match(df, "agency_id", agency_ids, "agency", True)
    kept = [F.col(c) for c in df.columns if not c.startswith(("src_", "dst_", "merchant_hit", "agency_hit"))]
    return df.select(
        *kept,
        unresolved("source_account_id", "src").alias("missing_source_account"),
        unresolved("destination_account_id", "dst").alias("missing_destination_account"),
        missing_merchant_test().alias("missing_merchant"),
        (
            dangling("source_account_id", "src_core")
            | dangling("destination_account_id", "dst_core")
            | dangling("merchant_id", "merchant_hit")
            | dangling("agency_id", "agency_hit")
        ).alias("missing_core_reference"),
    )


def _ref(column: str, parent: str) -> Column:
    """How a reference names its parent: accounts by their text, the others by their number,
    or by their digits if that is too large a number to be an id."""
    if parent == "account":
        return empty_to_null(column)
    return F.when(F.col(column).rlike(DIGITS), F.coalesce(numeric_id(column).cast("string"), F.col(column)))


REFERENCES = (("src", "source_account_id", "account"), ("dst", "destination_account_id", "account"),
              ("merchant", "merchant_id", "merchant"), ("agency", "agency_id", "agency"))


def _named(tx: DataFrame, columns: Sequence[str], references=REFERENCES) -> DataFrame:
    """The references of each row that name a parent: DF[*columns, name, parent, ref], repeats included."""
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("parent"), _ref(c, p).alias("ref")) for n, c, p in references])
    return tx.select(*columns, F.explode(names).alias("_n")).select(
        *columns, "_n.name", "_n.parent", "_n.ref").where(F.col("ref").isNotNull())


def named_parents(tx: DataFrame, *columns: str, parents: Sequence[str] = ("account", "merchant", "agency")) -> DataFrame:
    """The same without the name of the reference: DF[*columns, parent, ref]. A row that names
    one account on both sides names it once."""
    named = [r for r in REFERENCES if r[2] in parents]
    if "account" in parents:
        other = F.col("destination_account_id")
        tx = tx.withColumn("destination_account_id", F.when(other == F.col("source_account_id"), F.lit(None)).otherwise(other))
    return _named(tx, columns, named).drop("name")


def orphans(
    tx: DataFrame, accounts: DataFrame, core_accounts: DataFrame, merchants: DataFrame, agencies: DataFrame,
) -> DataFrame:
    """The references that do not resolve, each once: DF[parent, ref, staged].

    Every row names four parents; tasks make the names distinct before they are sent, so a
    parent that a third of the rows name is one row per task, and each name meets its parent
    once. ``staged`` says that an account is staged, though not in core. Stored, the few
    orphans tell Spark their size, and the rows meet them without being shuffled
    (``with_orphans``)."""
    return orphans_of(named_parents(tx).distinct(), accounts, core_accounts, merchants, agencies)


def orphans_of(
    named: DataFrame, accounts: DataFrame, core_accounts: DataFrame, merchants: DataFrame, agencies: DataFrame,
) -> DataFrame:
    """The same from the distinct names DF[parent, ref]."""
    known = known_accounts(accounts, core_accounts).select(
        F.lit("account").alias("parent"), F.col("key").alias("ref"), F.lit(True).alias("staged"), F.col("core").alias("core"))
    for parent, rows in (("merchant", merchants), ("agency", agencies)):
        known = known.unionByName(known_ids(rows).select(
            F.lit(parent).alias("parent"), F.col("key").cast("string").alias("ref"), F.lit(True).alias("staged"), F.lit(True).alias("core")))
    found = named.join(known, ["parent", "ref"], "left")
    numeric = (F.col("parent") != "account") | F.coalesce(F.col("ref").rlike(DIGITS), F.lit(False))
    lost = F.col("staged").isNull() | (numeric & F.col("core").isNull())
    return found.where(lost).select("parent", "ref", F.coalesce("staged", F.lit(False)).alias("staged"))


def with_orphans(rows: DataFrame, lost: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """The booleans of ``with_holds`` from the stored orphans: one table, or one by parent,
    so that few orphans of one parent are known to be few beside many of another."""
    df = rows
    for name, column, parent in REFERENCES:
        side = (lost[parent] if isinstance(lost, Mapping) else lost).where(F.col("parent") == parent).select(
            F.col("ref").alias(f"{name}_key"), F.col("staged").alias(f"{name}_staged"))
        df = lookup_join(df.withColumn(f"{name}_ref", _ref(column, parent)), side, f"{name}_ref", f"{name}_key", "left").drop(f"{name}_ref")

    def unknown(name: str) -> Column:
        return F.coalesce(~F.col(f"{name}_staged"), F.lit(False))

    def dangles(name: str, column: str) -> Column:
        return F.col(f"{name}_key").isNotNull() & F.coalesce(F.col(column).rlike(DIGITS), F.lit(False))

    return df.select(
        *rows.columns,
        (blank("source_account_id") | unknown("src")).alias("missing_source_account"),
        (blank("destination_account_id") | unknown("dst")).alias("missing_destination_account"),
        missing_merchant_test().alias("missing_merchant"),
        (
            dangles("src", "source_account_id") | dangles("dst", "destination_account_id")
            | dangles("merchant", "merchant_id") | dangles("agency", "agency_id")
        ).alias("missing_core_reference"),
    )


def blank_holds() -> dict[str, Column]:
    """The quarantine reasons that a row shows by itself."""
    return {"missing_source_account": blank("source_account_id"), "missing_destination_account": blank("destination_account_id"),
            "missing_merchant": missing_merchant_test()}


def orphan_hits(rows: DataFrame, lost: DataFrame | Mapping[str, DataFrame]) -> DataFrame:
    """The other reasons of ``with_orphans``, one row per orphan that a row names: DF[id, code, core],
    ``code`` for an account that is not staged, ``core`` for a number that is not in core.

    Only ids and references travel, both accounts of a row in one join, and rows whose
    parents are known end there."""
    hits = None
    for parents in (("account",), ("merchant", "agency")):
        side = lost[parents[0]] if isinstance(lost, Mapping) else lost
        side = side.where(F.col("parent").isin(*parents)).select("parent", "ref", "staged")
        found = _named(rows, ["id"], [r for r in REFERENCES if r[2] in parents]).join(side, ["parent", "ref"])
        code = F.when(~F.col("staged") & (F.col("name") == "src"), "missing_source_account").when(
            ~F.col("staged") & (F.col("name") == "dst"), "missing_destination_account")
        core = (F.col("parent") != "account") | F.col("ref").rlike(DIGITS)
        part = found.select("id", code.alias("code"), core.alias("core"))
        hits = part if hits is None else hits.unionByName(part)
    return hits


STAGED_REASONS = ("missing_source_account", "missing_destination_account", "missing_merchant")


def quarantine(
    tx: DataFrame, anomalies: Sequence[DataFrame], accounts: DataFrame,
    core_accounts: DataFrame, merchants: DataFrame, agencies: DataFrame,
) -> DataFrame:
    """All quarantine rows by priority: none for an anomalous transaction, and no core
    reference row for one that an earlier reason already holds. A transaction may have
    several rows, one per reason.

    A first pass over the six columns that the rules read finds the ids that are held;
    the wide rows meet those ids once, and only they take part in the second pass, which
    names the reasons of each row.
    """
    sides = (known_accounts(accounts, core_accounts), known_ids(merchants), known_ids(agencies))
    narrow = exclude(tx.select(*HOLD_COLUMNS), *anomalies, id="id")
    held = (
        with_holds(narrow, *sides)
        .where(any_of(tuple(QUARANTINE)))
        .groupBy(F.col("id").alias("_held"))
        .agg(F.bool_or(any_of(STAGED_REASONS)).alias("_staged"))
    )
    rows = lookup_join(tx, held, "id", "_held", "inner").drop("_held")
    tests = [(r, F.col(r) if r in STAGED_REASONS else F.col(r) & ~F.col("_staged")) for r in QUARANTINE]
    hits = explode_hits(with_holds(rows, *sides), tests, "_reason")
    texts = F.create_map(*[F.lit(x) for kv in QUARANTINE.items() for x in kv])
    return issue_rows(
        hits.select(*tx.columns, "_reason"), F.col("_reason"), F.element_at(texts, F.col("_reason")), "reject")


def quarantine_of(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """The same issue rows for transactions that were routed to quarantine, from the orphans;
    ``reasons`` says whether a transaction is held for a staged reason already."""
    source = [c for c in rows.columns if c not in ("route", "reasons", "source_position")]
    staged = F.arrays_overlap("reasons", F.array(*[F.lit(r) for r in STAGED_REASONS]))
    flagged = with_orphans(rows.withColumn("_staged", staged), lost)
    tests = [(r, F.col(r) if r in STAGED_REASONS else F.col(r) & ~F.col("_staged")) for r in QUARANTINE]
    hits = explode_hits(flagged, tests, "_reason")
    texts = F.create_map(*[F.lit(x) for kv in QUARANTINE.items() for x in kv])
    return issue_rows(hits.select(*source, "_reason"), F.col("_reason"), F.element_at(texts, F.col("_reason")), "reject")


def reason_catalogue(spark: SparkSession, old: DataFrame | None = None) -> DataFrame:
    """The codes that are written, with their texts; existing rows are overwritten."""
    codes = F.array(*[
        F.struct(F.lit(c).alias("reason_code"), F.lit(d).alias("description"))
        for c, d in QUARANTINE.items()
    ])
    new = spark.range(1).select(F.explode(codes).alias("r")).select("r.*")
    return new if old is None else upsert(old, new, "reason_code")


def missing_required(tx: DataFrame, tx_types: DataFrame) -> DataFrame:
    """Optional policy: what the transaction type requires must be there.

    ``tx_types`` is the typed lookup with its ``requires_*`` flags. The lookup has one
    row per code; Catalyst broadcasts it if it is small.
    """
    flags = tx_types.select(
        F.col("code").alias("_type"), *[f for f, _ in REQUIRED.values()])
    typed = lookup_join(tx, flags, "transaction_type", "_type", "inner")
    tests = [(reason, F.col(f) & blank(c)) for reason, (f, c) in REQUIRED.items()]
    hits = explode_hits(typed, tests, "_reason").select(*tx.columns, "_reason")
    details = F.concat(F.lit("The transaction type requires "), F.regexp_replace("_reason", "^missing_", ""))
    return issue_rows(hits, F.col("_reason"), details, "reject")
