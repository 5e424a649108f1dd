"""Dimension joins, incremental filters and reconciliation.

Hot keys: the frame that may hold one very common key is always on the side adaptive execution can
split (the left of an anti or outer join), and the other side is brought down to one row per key
first. Sides that only get compared by totals are stacked and aggregated instead of joined, so no
pairs arise.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

ONLY_LEFT, ONLY_RIGHT, MATCH, AMOUNT_DIFF = "ONLY_LEFT", "ONLY_RIGHT", "MATCH", "AMOUNT_DIFF"
UNREADABLE = "UNREADABLE"


def join_dimension(
    facts: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on shared names; the optimizer broadcasts the dimension when its size allows."""
    return facts.join(dimension, on=on, how=how)


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def _check_keys(keys: list[str], **frames: DataFrame) -> None:
    """Stop at the first frame that lacks a key, and say which."""
    for side, frame in frames.items():
        absent = set(keys).difference(frame.columns)
        if absent:
            raise KeyError(f"{side} has no column {', '.join(sorted(absent))}")


def _anti(left: DataFrame, right: DataFrame, left_keys: list[Column]) -> DataFrame:
    """Rows of ``left`` without a partner; NULL equals NULL. ``right`` holds only the keys.

    The keys are exchanged twice on purpose: once to make them distinct, since a third of them may
    be one key, and once more, reduced, for the join. Adaptive execution splits a hot key of
    ``left`` only between two exchanges that the join itself asked for.
    """
    keys = right.distinct()
    same = [a.eqNullSafe(keys[name]) for a, name in zip(left_keys, keys.columns)]
    return left.join(keys, reduce(and_, same), "left_anti")


def new_rows(incoming: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key the target does not hold yet.

    Names are upper-cased, keys are compared as text, and a missing key counts as a value of its
    own. Duplicates within ``incoming`` stay. Keys whose types make the comparison the same without
    the text are left as they are, since numbers sort and hash faster.
    """
    left, right = upper_columns(incoming), upper_columns(target)
    names = [k.upper() for k in keys]
    _check_keys(names, incoming=left, target=right)
    kinds = [_text_equal_type(left.schema[n].dataType, right.schema[n].dataType) for n in names]
    right_keys = right.select(
        *[F.col(n).cast(kind).alias(f"_key_{i}") for i, (n, kind) in enumerate(zip(names, kinds))]
    )
    return _anti(left, right_keys, [left[n].cast(kind) for n, kind in zip(names, kinds)])


def _text_equal_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """A type in which two values are equal exactly when their texts are."""
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return T.LongType()
    exact = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    return left if left == right and isinstance(left, exact) else T.StringType()


def missing_from(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; NULL keys match each other."""
    _check_keys(keys, left=left, right=right)
    right_keys = right.select(*[F.col(n).alias(f"_key_{i}") for i, n in enumerate(keys)])
    return _anti(left, right_keys, [left[n] for n in keys])


def two_way_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on one side only, tagged with the side and the number of rows there.

    Both sides are stacked and counted per key, one shuffle with map-side counts.
    """
    _check_keys(keys, left=left, right=right)
    tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counted = tagged.groupBy(*keys).agg(
        F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows")
    )
    one_sided = counted.filter((F.col("left_rows") == 0) | (F.col("right_rows") == 0))
    side = F.when(F.col("right_rows") == 0, ONLY_LEFT).otherwise(ONLY_RIGHT)
    return one_sided.withColumn("side", side)


def amount_difference(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_amount: str,
    right_amount: str,
    decimals: int = 2,
) -> DataFrame:
    """Compare summed amounts per key between two parties.

    ``status`` is UNREADABLE where an amount of either side is no number of 38 digits, else MATCH,
    AMOUNT_DIFF, ONLY_LEFT or ONLY_RIGHT; an amount against none is a difference. Amounts are summed
    as decimals, so the comparison is exact to ``decimals`` places, and ``unreadable`` counts those
    that the sums leave out.
    """
    _check_keys(keys, left=left, right=right)
    money = f"decimal(38,{decimals})"
    nothing = F.lit(None).cast(money)

    def side(df: DataFrame, amount: str, is_left: bool) -> DataFrame:
        value = F.col(amount).try_cast(money)
        return df.select(
            *keys,
            F.lit(int(is_left)).alias("_l"),
            F.lit(int(not is_left)).alias("_r"),
            (value if is_left else nothing).alias("_la"),
            (nothing if is_left else value).alias("_ra"),
            (F.col(amount).isNotNull() & value.isNull()).cast("long").alias("_bad"),
        )

    totals = (
        side(left, left_amount, True)
        .unionByName(side(right, right_amount, False))
        .groupBy(*keys)
        .agg(
            F.sum("_l").alias("_ln"),
            F.sum("_r").alias("_rn"),
            F.sum("_la").alias("left_amount"),
            F.sum("_ra").alias("right_amount"),
            F.sum("_bad").alias("unreadable"),
        )
    )
    zero = F.lit(0).cast(money)
    gap = F.coalesce("left_amount", zero) - F.coalesce("right_amount", zero)
    status = (
        F.when(F.col("unreadable") > 0, UNREADABLE)
        .when(F.col("_rn") == 0, ONLY_LEFT)
        .when(F.col("_ln") == 0, ONLY_RIGHT)
        .when(F.col("left_amount").eqNullSafe(F.col("right_amount")), MATCH)
        .otherwise(AMOUNT_DIFF)
    )
    return totals.select(
        *keys, "left_amount", "right_amount", gap.alias("difference"), status.alias("status"),
        "unreadable",
    )


def is_refund(amount: str, decimals: int = 2) -> Column:
    """Whether an amount, read as the sums read it, is negative.

    An amount that is missing or unreadable is none; it stays with the transactions, where it shows.
    """
    return F.coalesce(F.col(amount).try_cast(f"decimal(38,{decimals})") < 0, F.lit(False))


def split_refunds(
    df: DataFrame, amount: str, decimals: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Transactions and refunds, which are the rows of a negative amount."""
    return df.filter(~is_refund(amount, decimals)), df.filter(is_refund(amount, decimals))


def reconcile_amounts(
    left: DataFrame, right: DataFrame, keys: list[str], left_amount: str, right_amount: str,
    decimals: int = 2,
) -> DataFrame:
    """``amount_difference`` of transactions and of refunds apart, told by ``kind``."""
    ours = split_refunds(left, left_amount, decimals)
    theirs = split_refunds(right, right_amount, decimals)
    found = [
        amount_difference(a, b, keys, left_amount, right_amount, decimals).withColumn("kind", F.lit(kind))
        for kind, a, b in zip(("TRANSACTION", "REFUND"), ours, theirs)
    ]
    return found[0].unionByName(found[1])


#: Columns of ``key_book`` beside the keys.
BOOK_KINDS = {"TRANSACTION": "txn", "REFUND": "ref"}


def key_book(
    left: DataFrame, right: DataFrame, keys: list[str], left_amount: str, right_amount: str,
    decimals: int = 2,
) -> DataFrame:
    """One row per key with all that two-sided reports ask of it.

    Rows of either side (``_ln``, ``_rn``), and for transactions (``_txn``) and refunds (``_ref``)
    apart the rows, the sums and the unreadable amounts of each side. Both sides are stacked and
    summed in one shuffle with map-side sums, so no pairs arise.
    """
    _check_keys(keys, left=left, right=right)
    money = f"decimal(38,{decimals})"

    def side(df: DataFrame, amount: str, letter: str) -> DataFrame:
        value, refund = F.col(amount).try_cast(money), is_refund(amount, decimals)
        unreadable = (F.col(amount).isNotNull() & value.isNull()).cast("long")
        return df.select(
            *keys, F.lit(letter).alias("_side"), F.when(refund, "ref").otherwise("txn").alias("_kind"),
            value.alias("_value"), unreadable.alias("_bad"),
        )

    rows = side(left, left_amount, "l").unionByName(side(right, right_amount, "r"))
    sums = []
    for kind in BOOK_KINDS.values():
        for letter in "lr":
            own = (F.col("_side") == letter) & (F.col("_kind") == kind)
            sums += [
                F.sum(own.cast("long")).alias(f"_{kind}_{letter}n"),
                F.sum(F.when(own, F.col("_value"))).alias(f"_{kind}_{letter}a"),
                F.sum(F.when(own, F.col("_bad"))).alias(f"_{kind}_{letter}bad"),
            ]
    counts = [F.sum((F.col("_side") == s).cast("long")).alias(f"_{s}n") for s in "lr"]
    return rows.groupBy(*keys).agg(*counts, *sums)


def book_differences(book: DataFrame, keys: list[str], kind: str, decimals: int = 2) -> DataFrame:
    """What ``reconcile_amounts`` says of one kind, from a ``key_book``."""
    at = BOOK_KINDS[kind]
    money = f"decimal(38,{decimals})"
    zero = F.lit(0).cast(money)
    ours, theirs = F.col(f"_{at}_la"), F.col(f"_{at}_ra")
    unreadable = F.coalesce(f"_{at}_lbad", F.lit(0)) + F.coalesce(f"_{at}_rbad", F.lit(0))
    status = (
        F.when(unreadable > 0, UNREADABLE)
        .when(F.col(f"_{at}_rn") == 0, ONLY_LEFT)
        .when(F.col(f"_{at}_ln") == 0, ONLY_RIGHT)
        .when(ours.eqNullSafe(theirs), MATCH)
        .otherwise(AMOUNT_DIFF)
    )
    met = book.filter((F.col(f"_{at}_ln") > 0) | (F.col(f"_{at}_rn") > 0))
    return met.select(
        *keys, ours.alias("left_amount"), theirs.alias("right_amount"),
        (F.coalesce(ours, zero) - F.coalesce(theirs, zero)).alias("difference"),
        status.alias("status"), unreadable.alias("unreadable"),
    )


def rows_of_keys(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in ``found``, which has each key once; NULL equals NULL. The comparison lays
    ``found`` out anew, so adaptive execution can split a hot key of ``rows``."""
    known = found.select(*[F.col(n).alias(f"_key_{i}") for i, n in enumerate(keys)])
    same = [rows[n].eqNullSafe(known[f"_key_{i}"]) for i, n in enumerate(keys)]
    return rows.join(known, reduce(and_, same), "left_semi")


def invalid_accounts(
    rows: DataFrame, accounts: DataFrame, key: str, name: str, account_name: str
) -> DataFrame:
    """Rows whose account name is not the one that the accounts have, or that have no account.

    Names are compared trimmed and in upper case; ``core_name`` is the account's, NULL where there
    is no such account. Empty when all agree. ``accounts`` has one row per key, else the job stops.
    """
    core = _one_per_key(accounts.select(key, F.col(account_name).alias("core_name")), key)
    joined = _look_up(rows, core, key)
    same = F.upper(F.btrim(name)).eqNullSafe(F.upper(F.btrim("core_name")))
    return joined.filter(F.col("core_name").isNull() | ~same)


def _one_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """Distinct rows of a two-column lookup; a key with two values stops the job.

    Both steps are hash aggregates: the distinct pairs, then how many there are per key.
    """
    value = next(c for c in lookup.columns if c != key)
    pairs = lookup.select(key, value).distinct()
    counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_values"))
    message = F.concat(F.lit(f"more than one {value} for {key} "), F.col(key).cast("string"))
    checked = F.when(F.col("_values") > 1, F.raise_error(message).cast(lookup.schema[value].dataType))
    return pairs.join(counts, key).select(key, checked.otherwise(F.col(value)).alias(value))


def detokenise(
    df: DataFrame, vault: DataFrame, token: str = "token", value: str = "value"
) -> DataFrame:
    """Look tokens up in a vault; ``found`` tells whether there was one.

    A token that the vault has with two values stops the job.
    """
    known = _one_per_key(vault.select(token, value), token).withColumn("_hit", F.lit(True))
    joined = _look_up(df, known, token)
    return joined.withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def _look_up(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup of one row per key.

    The null-safe comparison lays the lookup out anew after it was reduced to one row per key;
    adaptive execution splits a hot key of ``df`` only between two exchanges.
    """
    known = lookup.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_known")
    joined = df.join(known, df[key].eqNullSafe(known["_known"]), "left").drop("_known")
    return joined.select(key, *[c for c in joined.columns if c != key])


def attach_surrogate_key(
    facts: DataFrame, dimension: DataFrame, natural_key: str, surrogate_key: str
) -> DataFrame:
    """Bring the dimension's surrogate key to the facts; unknown keys give NULL.

    A natural key with two surrogate keys stops the job.
    """
    lookup = _one_per_key(dimension.select(natural_key, surrogate_key), natural_key)
    return _look_up(facts, lookup, natural_key)
