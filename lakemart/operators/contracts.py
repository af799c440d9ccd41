"""Contract validation: clean rows, rejected rows and a row-level issue log.

The rules a row breaks are kept as the bits of one long (several beyond 63 rules), so that clean rows, the bulk of every
table, cost next to nothing; the log is spelled out for rejected rows only. Rules that look at other rows (unique, foreign key) are first
reduced to the small set of *offending keys* with narrow, map-side combined aggregates; the wide table then meets that
set in a left join. Given a ``Workspace`` the key sets are written before use, so the planner knows their real size: it broadcasts
the small ones, leaving the wide table unshuffled, and otherwise falls back to a sort-merge join that AQE splits on
hot keys. Many whole-number keys are packed as the bits of words, 64 neighbouring numbers to a word; while the words are few,
they go to every task and the wide table stays where it is. Where many keys are repeated, their copies are ranked in the
one shuffle of the wide table instead; only the hot ones, whose rows are spread over all tasks, are looked up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.scalars import half_up, holds, is_blank, listed, literal, number, quoted
from lakemart.sources.lake import Workspace
from lakemart.sources.model import TableContract

ISSUES = "_issues"
CLEAN = "_is_clean"
_BITS = 63
_FEW = 100_000  # repeated keys up to which they are all looked up
_WORDS = 1 << 20  # words of packed keys up to which they are broadcast (some 40 MB in memory)
_HOT = 10_000  # beyond that, copies from which the rows of a key are spread over tasks instead of ranked in one


@dataclass(frozen=True)
class Validation:
    """One validated table; every view of it is derived from the same annotated frame.

    Bit ``i % 63`` of issue column ``i // 63`` tells that a row breaks ``rules[i]``, a pair of column name and issue
    type. ``unique`` names the columns that hold no value twice among the clean rows. ``surplus`` tells, where it was
    counted, how many rows of a unique column come on top of one for each value.
    """

    table: str
    annotated: DataFrame
    row_order: tuple[str, ...]
    rules: tuple[tuple[str, str], ...] = ()
    missing_columns: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    surplus: Mapping[str, int] = field(default_factory=dict)

    @property
    def words(self) -> tuple[str, ...]:
        return issue_columns(len(self.rules))

    def failed(self) -> str:
        if CLEAN in self.annotated.columns:
            return f"not {CLEAN}"
        return "true" if self.missing_columns else self.broken()

    def broken(self) -> str:
        return " or ".join(f"{word} <> 0" for word in self.words)

    def clean(self) -> DataFrame:
        return self.annotated.where(f"not ({self.failed()})").drop(*self.words, CLEAN)

    def rejected(self) -> DataFrame:
        rows = self.annotated.where(self.failed()).drop(*self.words, CLEAN)
        return rows.selectExpr(f"{literal(self.table)} as rejected_from", "*")

    def first_copies(self, column: str) -> DataFrame | None:
        """One row, clean or not, for each value of a unique column: the first by the row order, nulls last.

        None where the marks do not tell it: copies share the first position, or several columns with nulls make it.
        """
        if column not in self.surplus:
            return None
        rows = self.annotated
        if self.surplus[column]:
            bit = self.rules.index((column, "duplicate_key"))
            later = f"({self.words[bit // _BITS]} & {1 << bit % _BITS}L) <> 0"
            several = self.row_order if len(self.row_order) > 1 else ()
            unknown = " or ".join(f"{quoted(name)} is null" for name in several) or "false"
            found, open_places = rows.agg(F.expr(f"count_if({later})"), F.expr(f"count_if({unknown})")).first()
            if found != self.surplus[column] or open_places:
                return None
            rows = rows.where(f"not ({later})")
        return rows.drop(*self.words, CLEAN)

    def issues(self, *keys: str) -> DataFrame:
        """One row per violated rule; ``keys`` names columns that tell the row (the row order if empty)."""
        keep = [quoted(name) for name in keys or self.row_order]
        entries = [
            f"if(({self.words[bit // _BITS]} & {1 << bit % _BITS}L) <> 0, named_struct('column_name', {literal(name)}, 'issue_type',"
            f" {literal(kind)}, 'value', string({quoted(name)})), null)"
            for bit, (name, kind) in enumerate(self.rules)
        ]
        table = f"{literal(self.table)} as table_name"
        if entries:
            rows = self.annotated.where(self.failed()).where(self.broken())
            listed_issues = rows.selectExpr(*keep, f"explode(array_compact(array({', '.join(entries)}))) as i")
            log = listed_issues.selectExpr(table, "i.column_name", "i.issue_type", *keep, "i.value")
        else:
            none = self.annotated.where("false")
            log = none.selectExpr(table, "'' as column_name", "'' as issue_type", *keep, "'' as value")
        kinds = {field.name: field.dataType.simpleString() for field in log.schema}
        for column in self.missing_columns:
            whole = self.annotated.sparkSession.range(1).selectExpr(
                table,
                f"{literal(column)} as column_name",
                "'missing_required_column' as issue_type",
                *[f"cast(null as {kinds[name]}) as {quoted(name)}" for name in keys or self.row_order],
                "cast(null as string) as value",
            )
            log = log.unionByName(whole)
        return log

    def summary(self) -> DataFrame:
        """Row counts and score of this table, in one pass over the annotated frame."""
        bits = " + ".join(f"bit_count({word})" for word in self.words)
        found = f"bigint(coalesce(sum({bits}), 0) + {len(self.missing_columns)})"
        counted = self.annotated.agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.expr(f"count_if(not ({self.failed()}))").alias("clean_rows"),
            F.expr(found).alias("validation_issues"),
        )
        score = half_up("double(clean_rows) / nullif(double(raw_rows), 0.0D) * 100.0D", 2)
        return counted.selectExpr(
            f"{literal(self.table)} as table_name",
            "raw_rows",
            "clean_rows",
            "raw_rows - clean_rows as rejected_rows",
            "validation_issues",
            f"coalesce({score}, 100.0D) as quality_score",
        )


@dataclass(frozen=True)
class Repeats:
    """Some keys of a unique column occur more than once.

    ``firsts`` holds copies and first position of such keys: of all, or with ``ranked`` only of the hot ones (None if
    there is none), and the copies of the others are ranked. ``surplus`` counts the rows beyond one for each key.
    """

    firsts: DataFrame | None
    ranked: bool
    surplus: int | None = None


@dataclass(frozen=True)
class Packed:
    """Whole-number keys as bits: bit ``k % 64`` of the word numbered ``k // 64``. The frame holds number and bits."""

    words: DataFrame


KeySets = Mapping[str, "DataFrame | Repeats | Packed | None"]


def issue_columns(rules: int) -> tuple[str, ...]:
    """Names of the columns that hold the bits of so many rules."""
    return tuple(ISSUES if k == 0 else f"{ISSUES}_{k}" for k in range(max(1, -(-rules // _BITS))))


def annotate(
    frame: DataFrame,
    contract: TableContract,
    parents: Mapping[str, DataFrame],
    row_order: Sequence[str],
    workspace: Workspace | None = None,
) -> Validation:
    """Check ``frame`` against ``contract``; ``parents`` holds the *clean* rows of tables checked before.

    ``row_order`` names the columns whose values order the rows of the table totally (file position or a business
    order); it decides which copy of a duplicate key comes first.
    """
    keys = offending_keys(frame, contract, parents, row_order, workspace)
    if workspace:
        keys = _save_sets(workspace, keys)
    return mark(frame, contract, row_order, keys)


def _save_sets(workspace: Workspace, keys: KeySets) -> KeySets:
    """Write key sets side by side; a set without keys becomes None, so that its rule costs no join."""
    saved = workspace.save_all({name: frame for name, frame in keys.items() if isinstance(frame, DataFrame)})
    if not saved:
        return dict(keys)
    with ThreadPoolExecutor(len(saved)) as pool:
        empty = dict(zip(saved, pool.map(DataFrame.isEmpty, saved.values()), strict=True))
    return {name: frame if name not in saved else None if empty[name] else saved[name] for name, frame in keys.items()}


def offending_keys(
    frame: DataFrame,
    contract: TableContract,
    parents: Mapping[str, DataFrame],
    row_order: Sequence[str],
    workspace: Workspace | None = None,
) -> dict[str, DataFrame | Repeats | None]:
    """The key sets behind the rules that look at other rows, one narrow frame per rule; None if no key offends."""
    found: dict[str, DataFrame | Repeats | None] = {}
    for name in contract.unique:
        if name in frame.columns:
            place, counts = _set_name(contract, name, "repeated"), repeated_counts(frame, name)
            if not workspace:
                found[place] = Repeats(first_positions(frame, name, counts, row_order), ranked=False)
                continue
            counts = workspace.save(counts, _set_name(contract, name, "counts"))
            repeated, most, surplus = counts.agg(F.count(F.lit(1)), F.max("copies"), F.sum(F.col("copies") - 1)).first()
            found[place] = Repeats(None, True, surplus) if repeated else None
            if (least := _looked_up(repeated, most)) is not None:
                known = workspace.save(counts.where(f"copies > {least}"), _set_name(contract, name, "known"))
                firsts = workspace.save(first_positions(frame, name, known, row_order), place)
                found[place] = Repeats(firsts, repeated > _FEW, surplus)
    for name, (parent, column) in contract.foreign_keys.items():
        if name in frame.columns and parent in parents and column in parents[parent].columns:
            found[_set_name(contract, name, "orphans")] = missing_parents(frame, name, parents[parent], column)
    return found


def _looked_up(repeated: int, most: int | None) -> int | None:
    """Copies beyond which a repeated key is looked up; None if no key is."""
    if not repeated:
        return None
    least = 1 if repeated <= _FEW else _HOT
    return least if most > least else None


def mark(
    frame: DataFrame, contract: TableContract, row_order: Sequence[str], keys: KeySets
) -> Validation:
    """Attach to every row the list of rules it breaks; rules whose key set is not in ``keys`` do not apply."""
    wide = frame
    repeats, orphans = {}, {}
    for name in contract.unique:
        if (place := _set_name(contract, name, "repeated")) not in keys:
            continue
        repeats[name] = "false"
        if (repeated := keys[place]) is not None and repeated.ranked:
            wide, repeats[name] = _rank_copies(wide, repeated.firsts, name, row_order)
        elif repeated is not None:
            wide, repeats[name] = _join_repeated(wide, repeated.firsts, name, row_order)
    for name in contract.foreign_keys:
        if (place := _set_name(contract, name, "orphans")) not in keys:
            continue
        orphans[name] = f"{quoted(name)} is null"
        if (missing := keys[place]) is not None:
            wide, orphans[name] = _join_orphans(wide, missing, name)

    rules = _rules(frame, contract, repeats, orphans)
    bits = [f"if({condition}, {1 << bit % _BITS}L, 0L)" for bit, (_, _, condition) in enumerate(rules)]
    sums = [
        f"{' + '.join(bits[k * _BITS : (k + 1) * _BITS]) or '0L'} as {word}"
        for k, word in enumerate(issue_columns(len(rules)))
    ]
    annotated = wide.selectExpr(*[quoted(name) for name in frame.columns], *sums)
    absent = tuple(name for name in contract.required if name not in frame.columns)
    named = tuple((name, kind) for name, kind, _ in rules)
    found = {name: keys[_set_name(contract, name, "repeated")] for name in repeats}
    surplus = {name: 0 if known is None else known.surplus for name, known in found.items()}
    counted = {name: rows for name, rows in surplus.items() if rows is not None}
    return Validation(contract.table, annotated, tuple(row_order), named, absent, tuple(repeats), counted)


def _rules(
    frame: DataFrame, contract: TableContract, repeats: Mapping[str, str], orphans: Mapping[str, str]
) -> list[tuple[str, str, str]]:
    """Column, issue type and SQL condition of every rule whose column exists; unknown never counts as broken."""
    present = set(frame.columns)
    rules = [
        (name, "missing_required_value", is_blank(frame, name)) for name in contract.required if name in present
    ]
    rules += [(name, "duplicate_key", condition) for name, condition in repeats.items()]
    for name in contract.positive:
        if name in present:
            rules.append((name, "not_positive", holds(f"{number(frame, name)} <= 0")))
    for name in contract.non_negative:
        if name in present:
            rules.append((name, "negative_value", holds(f"{number(frame, name)} < 0")))
    for name, values in contract.allowed.items():
        if name in present:
            inside = holds(f"string({quoted(name)}) in ({listed(values)})")
            rules.append((name, "invalid_allowed_value", f"not {inside}"))
    for name, condition in orphans.items():
        parent, column = contract.foreign_keys[name]
        rules.append((name, f"missing_fk:{parent}.{column}", condition))
    return rules


def _set_name(contract: TableContract, name: str, kind: str) -> str:
    return f"{contract.table}_{name}_{kind}"


def position(row_order: Sequence[str]) -> str:
    """The row order as one comparable value."""
    return quoted(row_order[0]) if len(row_order) == 1 else f"struct({', '.join(map(quoted, row_order))})"


def repeated_counts(frame: DataFrame, name: str) -> DataFrame:
    """Keys that occur more than once, with their count; nulls count as one key. A hash aggregate of longs."""
    return frame.groupBy(name).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def first_positions(frame: DataFrame, name: str, counts: DataFrame, row_order: Sequence[str]) -> DataFrame:
    """Add the first position of each repeated key. Only the rows of such keys are ordered, the others never are."""
    keys = counts.toDF("_repeated", "copies")
    few = frame.select(name, *[c for c in row_order if c != name])
    few = few.join(keys, F.expr(f"{quoted(name)} <=> _repeated"))
    first = F.expr(f"min({position(row_order)})").alias("first")
    return few.groupBy(name).agg(F.max("copies").alias("copies"), first)


def _join_repeated(
    wide: DataFrame, repeated: DataFrame, name: str, row_order: Sequence[str]
) -> tuple[DataFrame, str]:
    key, copies, first = (f"_{part}_{name}" for part in ("key", "copies", "first"))
    same = F.expr(f"{quoted(name)} <=> {quoted(key)}")
    joined = wide.join(repeated.toDF(key, copies, first), same, "left")
    # Order columns may hold nulls, hence the null-safe comparison; the count tells matched rows apart.
    return joined, f"{quoted(copies)} is not null and not ({position(row_order)} <=> {quoted(first)})"


def _rank_copies(
    wide: DataFrame, hot: DataFrame | None, name: str, row_order: Sequence[str]
) -> tuple[DataFrame, str]:
    """Rank the rows of each key by their position, those of hot keys excepted: they are dealt out and compared."""
    later = f"{quoted(f'_rank_{name}')} > 1"
    spread: list[str] = []
    if hot is not None:
        wide, behind = _join_repeated(wide, hot, name, row_order)
        copies, spread = quoted(f"_copies_{name}"), [f"_spread_{name}"]
        wide = wide.selectExpr("*", f"if({copies} is null, -1L, monotonically_increasing_id() % 1024) as {quoted(spread[0])}")
        later = f"if({copies} is null, {later}, {behind})"
    # Ties have one rank, so equal positions are all first ones; nulls stand where the least position has them.
    single = len(row_order) == 1
    order = [F.col(quoted(c)).asc_nulls_last() if single else F.col(quoted(c)).asc_nulls_first() for c in row_order]
    copies_of_key = Window.partitionBy(*[F.col(quoted(c)) for c in (name, *spread)]).orderBy(*order)
    return wide.withColumn(f"_rank_{name}", F.rank().over(copies_of_key)), later


def missing_parents(child: DataFrame, name: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null child keys that the parent lacks. The distinct runs first, so hot keys shrink map-side."""
    keys = child.where(f"{quoted(name)} is not null").select(name).distinct()
    known = parent.selectExpr(f"{quoted(parent_column)} as _known")
    same = f"{quoted(name)} = _known"
    if child.schema[name].dataType != parent.schema[parent_column].dataType:
        same = f"string({quoted(name)}) = string(_known)"
    return keys.join(known, F.expr(same), "left_anti")


def _packed(keys: DataFrame, space: Workspace, name: str) -> DataFrame | Packed:
    """Keys of one column as words if they are many whole numbers that lie close enough, else as they are.

    What is broadcast is bounded by ``_WORDS``, whatever the keys are. Keys that lie apart stay with the join, and so do
    sets that hold a key several times, because bits would not tell.
    """
    (column,) = keys.columns
    if not isinstance(_kind(keys, column), _WHOLE):
        return keys
    number = f"bigint({quoted(column)})"
    word = F.expr(f"shiftright({number}, 6)")
    found, words = keys.agg(F.count(F.lit(1)), F.approx_count_distinct(word, 0.02)).first()
    if found <= _FEW or words > _WORDS:
        return keys
    bits = F.expr(f"bit_or(shiftleft(1L, int({number} & 63)))")
    packed = space.save(keys.groupBy(word.alias("word")).agg(bits.alias("bits")), name)
    return Packed(packed) if packed.agg(F.expr("sum(bit_count(bits))")).first()[0] == found else keys


def _pack_sets(
    keys: dict[str, dict[str, DataFrame | Repeats | Packed | None]], group: Sequence[str], space: Workspace
) -> None:
    """Pack the key sets of a generation, side by side."""
    sets = [(table, name) for table in group for name, found in keys[table].items() if isinstance(found, DataFrame)]
    with ThreadPoolExecutor(8) as pool:
        done = pool.map(lambda place: _packed(keys[place[0]][place[1]], space, f"{place[1]}_words"), sets)
        for (table, name), packed in zip(sets, done, strict=True):
            keys[table][name] = packed


def _join_orphans(wide: DataFrame, missing: DataFrame | Packed, name: str) -> tuple[DataFrame, str]:
    if isinstance(missing, Packed):
        word, bits = f"_word_{name}", f"_bits_{name}"
        number = f"bigint({quoted(name)})"
        near = F.expr(f"shiftright({number}, 6) = {quoted(word)}")
        joined = wide.join(F.broadcast(missing.words.toDF(word, bits)), near, "left")
        return joined, holds(f"{quoted(name)} is null or (shiftright({quoted(bits)}, int({number} & 63)) & 1L) = 1L")
    key = f"_orphan_{name}"
    joined = wide.join(missing.toDF(key), F.expr(f"{quoted(name)} = {quoted(key)}"), "left")
    return joined, f"{quoted(name)} is null or {quoted(key)} is not null"


def validate_all(
    raw: Mapping[str, DataFrame],
    contracts: Mapping[str, TableContract],
    row_order: Mapping[str, Sequence[str]],
    workspace: Workspace | None = None,
    target: Workspace | None = None,
) -> dict[str, Validation]:
    """Validate tables and their parents; children see only the clean rows of their parents.

    Without a workspace the whole cascade stays one lazy plan, table by table. With one, rejection travels as keys: one
    pass over the key columns of all tables finds repeated keys and orphans (``key_ledger``), then only keys that a
    parent lost travel down the foreign keys. The wide tables are marked and written once, those of a generation side
    by side, and the keys lost are read from what was written. They go to ``target`` where given.
    """
    chosen = {name: contracts[name] for name in contracts if name in raw}
    groups = generations(chosen)
    if workspace:
        done = _by_travelled_keys(raw, chosen, row_order, groups, workspace, target or workspace)
        return {name: done[name] for name in chosen}
    done = {}
    clean: dict[str, DataFrame] = {}
    for table in (name for group in groups for name in group):
        done[table] = annotate(raw[table], chosen[table], clean, row_order[table])
        clean[table] = done[table].clean()
    return {name: done[name] for name in chosen}


# --- the cascade as travelling keys ------------------------------------------------------------------------------

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PARENT = 0  # the row holds the key itself; other numbers are bits of the foreign keys that mention it


@dataclass(frozen=True)
class _Link:
    """A foreign key whose parent is validated too."""

    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def set_name(self) -> str:
        return f"{self.table}_{self.column}_orphans"


@dataclass(frozen=True)
class _Domain:
    """Keys that are compared with each other: a key column of a table, as whole numbers or as text."""

    table: str
    column: str
    as_text: bool


def _links(raw: Mapping[str, DataFrame], contracts: Mapping[str, TableContract]) -> list[_Link]:
    return [
        _Link(table, column, parent, parent_column)
        for table, contract in contracts.items()
        for column, (parent, parent_column) in contract.foreign_keys.items()
        if column in raw[table].columns and parent in contracts and parent_column in raw[parent].columns
    ]


def _kind(frame: DataFrame, column: str) -> T.DataType:
    return frame.schema[column].dataType


def _key_text(frame: DataFrame, column: str) -> str:
    """A key as text; both zeros of a floating number are one."""
    zero = " + 0.0D" if isinstance(_kind(frame, column), (T.FloatType, T.DoubleType)) else ""
    return f"string({quoted(column)}{zero})"


def _domains(
    raw: Mapping[str, DataFrame], contracts: Mapping[str, TableContract], links: Sequence[_Link]
) -> tuple[dict[tuple[str, str], _Domain], dict[_Link, _Domain]]:
    """The domain of every unique column, by table and column, and of every foreign key."""

    def whole(table: str, column: str) -> bool:
        return isinstance(_kind(raw[table], column), _WHOLE)

    unique = {
        (table, column): _Domain(table, column, not whole(table, column))
        for table, contract in contracts.items()
        for column in contract.unique
        if column in raw[table].columns
    }
    of_links = {
        link: _Domain(
            link.parent, link.parent_column, not (whole(link.table, link.column) and whole(link.parent, link.parent_column))
        )
        for link in links
    }
    return unique, of_links


def key_ledger(raw: Mapping[str, DataFrame], contracts: Mapping[str, TableContract]) -> DataFrame:
    """domain, number or text of a key, copies (rows that hold it), mentions (bits of the foreign keys that name it).

    Every table is read once, for its key columns only; its rows are spread over the domains and counted before the
    shuffle, so hot keys travel once a task. Domains and bits are numbered as in ``_Numbers``.
    """
    numbers = _Numbers(raw, contracts)
    parts = []
    for table, frame in raw.items():
        if entries := numbers.entries(table, frame):
            parts.append(frame.selectExpr(f"inline(array({', '.join(entries)}))").where("domain is not null"))
    if not parts:
        spark = next(iter(raw.values())).sparkSession
        return spark.createDataFrame([], "domain int, number long, text string, copies long, mentions long")
    keys = reduce(DataFrame.unionByName, parts)
    return keys.groupBy("domain", "number", "text").agg(
        F.count_if(F.col("side") == _PARENT).alias("copies"), F.bit_or("side").alias("mentions")
    )


class _Numbers:
    """Numbers of domains, and of the foreign keys inside their domain."""

    def __init__(self, raw: Mapping[str, DataFrame], contracts: Mapping[str, TableContract]):
        self.links = _links(raw, contracts)
        self.unique, self.of_links = _domains(raw, contracts, self.links)
        self.domains = list(dict.fromkeys([*self.unique.values(), *self.of_links.values()]))
        self.bits: dict[_Link, int] = {}
        for domain in self.domains:
            own = [link for link in self.links if self.of_links[link] == domain]
            if len(own) > _BITS:
                raise ValueError(f"more than {_BITS} foreign keys on {domain.table}.{domain.column}")
            self.bits.update({link: 1 << k for k, link in enumerate(own)})

    def entries(self, table: str, frame: DataFrame) -> list[str]:
        """One struct per domain to which a row of the table has something to say."""
        wanted = [(self.domains.index(d), d.column, d.as_text, _PARENT) for d in self.domains if d.table == table]
        for link in self.links:
            if link.table == table:
                domain = self.of_links[link]
                wanted.append((self.domains.index(domain), link.column, domain.as_text, self.bits[link]))
        out = []
        for domain, column, as_text, side in wanted:
            number = "cast(null as bigint)" if as_text else f"bigint({quoted(column)})"
            text = _key_text(frame, column) if as_text else "cast(null as string)"
            there = f"if({quoted(column)} is null, null, {domain})" if side else str(domain)
            out.append(f"named_struct('domain', {there}, 'number', {number}, 'text', {text}, 'side', {side}L)")
        return out


def _typed(domain: _Domain, kind: T.DataType) -> str:
    """The key of a ledger row in the type of a column."""
    return f"cast({'text' if domain.as_text else 'number'} as {kind.simpleString()})"


def _by_travelled_keys(
    raw: Mapping[str, DataFrame],
    contracts: Mapping[str, TableContract],
    row_order: Mapping[str, Sequence[str]],
    groups: Sequence[Sequence[str]],
    space: Workspace,
    target: Workspace,
) -> dict[str, Validation]:
    """All tables marked and written to ``target``, generation by generation.

    Repeated keys and orphans of the raw parents come from the ledger. The rejected rows of a written parent add the
    keys that no clean row of it holds; only tables that others mention are looked at, and only their key columns.
    """
    numbers = _Numbers(raw, contracts)
    ledger = key_ledger(raw, contracts)
    unique = [numbers.domains.index(domain) for domain in numbers.unique.values()]
    twice = (F.col("copies") > 1) & F.col("domain").isin(unique)
    kinds = F.when(twice, "repeated").when((F.col("copies") == 0) & (F.col("mentions") != 0), "orphan")
    offenders = ledger.withColumn("kind", kinds).where("kind is not null")
    offenders = space.save(offenders, "key_offenders", ("domain", "kind"))
    facts = offenders.groupBy("domain", "kind").agg(
        F.bit_or("mentions").alias("mentions"),
        F.count(F.lit(1)).alias("keys"),
        F.max("copies").alias("most"),
        F.sum(F.col("copies") - 1).alias("surplus"),
    )
    found = {(row.domain, row.kind): row for row in facts.collect()}

    def of(domain: _Domain, kind: str) -> DataFrame:
        return offenders.where((F.col("domain") == numbers.domains.index(domain)) & (F.col("kind") == kind))

    keys: dict[str, dict[str, DataFrame | Repeats | Packed | None]] = {table: {} for table in contracts}
    known: dict[tuple[str, str], DataFrame] = {}
    for (table, column), domain in numbers.unique.items():
        row = found.get((numbers.domains.index(domain), "repeated"))
        keys[table][_set_name(contracts[table], column, "repeated")] = Repeats(None, True, row.surplus) if row else None
        if row and (least := _looked_up(row["keys"], row.most)) is not None:
            typed = f"{_typed(domain, _kind(raw[table], column))} as {quoted(column)}"
            known[table, column] = of(domain, "repeated").where(f"copies > {least}").selectExpr(typed, "copies")
    # These keys are few, and written alone they are seen to be.
    counts = space.save_all({f"{table}_{column}_known": frame for (table, column), frame in known.items()})
    firsts = {
        _set_name(contracts[table], column, "repeated"): first_positions(raw[table], column, few, row_order[table])
        for (table, column), few in zip(known, counts.values(), strict=True)
    }
    for (table, column), (name, frame) in zip(known, space.save_all(firsts).items(), strict=True):
        row = found[numbers.domains.index(numbers.unique[table, column]), "repeated"]
        keys[table][name] = Repeats(frame, row["keys"] > _FEW, row.surplus)
    for link in numbers.links:
        domain, bit = numbers.of_links[link], numbers.bits[link]
        keys[link.table][link.set_name] = None
        row = found.get((numbers.domains.index(domain), "orphan"))
        if row and row.mentions & bit:
            typed = f"{_typed(domain, _kind(raw[link.table], link.column))} as {quoted(link.column)}"
            named = of(domain, "orphan").where(f"(mentions & {bit}L) <> 0")
            keys[link.table][link.set_name] = named.selectExpr(typed)

    done: dict[str, Validation] = {}
    mentioned = {link.parent for link in numbers.links}
    for group in groups:
        _pack_sets(keys, group, space)
        marked = settle([mark(raw[table], contracts[table], row_order[table], keys[table]) for table in group], target)
        done.update({result.table: result for result in marked})
        lost = {}
        for table in [t for t in group if t in mentioned and _can_reject(contracts[t], keys[t])]:
            for column in dict.fromkeys(link.parent_column for link in numbers.links if link.parent == table):
                lost[table, column] = _lost_keys(done[table], contracts[table], column)
        written = space.save_all({f"{table}_{column}_lost": frame for (table, column), frame in lost.items()})
        for place, frame in zip(lost, written.values(), strict=True):
            children = [link for link in numbers.links if (link.parent, link.parent_column) == place]
            if not frame.isEmpty():
                for link in children:
                    _add_lost(keys, link, frame, raw)
    return done


def validate_behind(
    frame: DataFrame,
    contract: TableContract,
    parents: Mapping[str, Validation],
    contracts: Mapping[str, TableContract],
    row_order: Sequence[str],
    space: Workspace,
) -> Validation:
    """Validate one more table behind parents that have been validated and written; it is marked and written like them.

    Keys that no row of a parent holds are found among the raw rows, and keys that a parent lost are read from it.
    """
    raw = {contract.table: frame, **{name: parent.annotated for name, parent in parents.items()}}
    sets = _save_sets(space, offending_keys(frame, contract, raw, row_order, space))
    keys = {contract.table: sets}
    for link in _links(raw, {contract.table: contract, **{name: contracts[name] for name in parents}}):
        if link.table == contract.table:
            lost = _lost_keys(parents[link.parent], contracts[link.parent], link.parent_column)
            lost = space.save(lost, f"{link.set_name}_lost")
            if not lost.isEmpty():
                _add_lost(keys, link, lost, raw)
    _pack_sets(keys, [contract.table], space)
    return settle([mark(frame, contract, row_order, keys[contract.table])], space)[0]


def _can_reject(contract: TableContract, keys: KeySets) -> bool:
    """Whether any rule may reject a row at all."""
    return bool(contract.required or contract.positive or contract.non_negative or contract.allowed or keys)


def _lost_keys(judged: Validation, contract: TableContract, column: str) -> DataFrame:
    """Keys of a parent that rejected rows hold and no clean row does."""
    failed = f"({judged.failed()})"
    rows = judged.annotated.where(f"{quoted(column)} is not null")
    if (column, "duplicate_key") in judged.rules:  # the first copy decides
        bit = judged.rules.index((column, "duplicate_key"))
        first = f"({judged.words[bit // _BITS]} & {1 << bit % _BITS}L) = 0"
        return rows.where(f"{failed} and {first}").select(column)
    candidates = rows.where(failed).select(column).distinct()
    held = rows.where(f"not {failed}").select(column)
    return candidates.join(held, column, "left_anti")


def _add_lost(
    keys: dict[str, dict[str, DataFrame | Repeats | Packed | None]], link: _Link, lost: DataFrame, raw: Mapping[str, DataFrame]
) -> None:
    """Keys that a parent lost, in the type of the child; no child key can be both lost and an orphan before."""
    kind = _kind(raw[link.table], link.column)
    if kind == _kind(raw[link.parent], link.parent_column):
        lost = lost.selectExpr(f"{quoted(link.parent_column)} as {quoted(link.column)}")
    else:
        text = _key_text(lost, link.parent_column)
        typed = f"try_cast({text} as {kind.simpleString()})"
        lost = lost.where(f"string({typed}) = {text}").selectExpr(f"{typed} as {quoted(link.column)}").distinct()
    before = keys[link.table][link.set_name]
    keys[link.table][link.set_name] = lost if before is None else before.union(lost)


def generations(contracts: Mapping[str, TableContract]) -> list[list[str]]:
    """Tables grouped so that every parent stands in an earlier group than its children, in whatever order they come.

    Parents that have no contract here are no tables of this run, and their rules are skipped. A cycle is an error.
    """
    left = {
        name: {parent for parent, _ in contract.foreign_keys.values() if parent in contracts}
        for name, contract in contracts.items()
    }
    groups: list[list[str]] = []
    while left:
        ready = [name for name, parents in left.items() if not parents & set(left)]
        if not ready:
            raise ValueError(f"foreign keys form a cycle: {', '.join(left)}")
        groups.append(ready)
        left = {name: parents for name, parents in left.items() if name not in ready}
    return groups


def settle(results: Sequence[Validation], store: Workspace) -> list[Validation]:
    """Write each annotated table once, split into a clean and a rejected partition.

    Clean rows, rejects, issues and counts are then pruned scans of that one table.
    """
    split = {r.table: r.annotated.selectExpr("*", f"not ({r.failed()}) as {CLEAN}") for r in results}
    written = store.save_all(split, (CLEAN,))
    return [replace(r, annotated=written[r.table]) for r in results]


def union_rejected(results: Sequence[Validation]) -> DataFrame:
    """All rejected rows, columns united by name in order of first sight."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [r.rejected() for r in results])


def issue_counts(results: Sequence[Validation]) -> DataFrame:
    logs = [r.issues().select("table_name", "issue_type") for r in results]
    return (
        reduce(DataFrame.unionByName, logs)
        .groupBy("table_name", "issue_type")
        .agg(F.count(F.lit(1)).alias("issues"))
    )


def contract_summary(results: Sequence[Validation]) -> DataFrame:
    return reduce(DataFrame.unionByName, [r.summary() for r in results])
