"""Files whose schema drifts: rescue-column ingestion and a report of each change.

Input: ``raw`` (file_id, line_no, line) and ``files`` (file_id, feed,
file_format csv|jsonl, separator, delivered_at). Further columns are ignored.

The lines are parsed once, into a written table of names and values. Its counts
give each field's kind in each file; the kinds decide how a value is read (a
bare integer is an amount in cents only where the file's field is integer).
The report compares the files' fields; a name that no list explains is matched
by replaying its rescued values into the type of the field it may stand for.

Defined results in odd cases
- a null or blank line, a csv line whose number of values differs from its
  header's and a broken json line give a row with no typed values whose
  ``_rescued`` holds {"_line": the line}; they count for no field;
- a file without lines has no fields; a csv file with a header only has its
  header's fields without values;
- a repeated name in one line: the last value stands;
- equal delivered_at in a feed: order by file_id; equal lines stay as they are;
- a file_id missing from ``files`` has no feed: its lines are rescued whole and
  it takes no part in the report.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marlstone.functions.scalars import is_absent, value_kind
from marlstone.session import materialise

# Names under which the feeds deliver a field of the trips.
ALIASES = {
    "congestion_surcharge": ("cbd_charge", "cong_surcharge", "congestion_fee", "congestionsurcharge", "surcharge_zone"),
    "do_location": ("dolocationid", "dropoff_zone"),
    "ehail_fee": ("app_fee", "e_hail_fee", "ehailfee", "hail_app_fee"),
    "passenger_count": ("passengers", "riders"),
    "payment_type": ("pay_kind", "paytype"),
    "pu_location": ("pickup_zone", "pulocationid"),
    "rate_type": ("fare_class", "rate_code_id", "ratecode", "ratetype", "tariff"),
    "tip_amount": ("gratuity",),
    "tolls_amount": ("toll_total",),
    "total_amount": ("total_charged",),
    "trip_type": ("hail_kind",),
    "vendor": ("operator", "vendor_id"),
}

# The target schema. money may come as cents or with a currency sign.
TARGET = {
    "trip_ref": "bigint",
    "vendor": "string",
    "lpep_pickup_datetime": "timestamp_ntz",
    "lpep_dropoff_datetime": "timestamp_ntz",
    "store_and_fwd_flag": "string",
    "rate_type": "string",
    "pu_location": "zone",
    "do_location": "zone",
    "passenger_count": "int",
    "trip_distance": "double",
    "fare_amount": "money",
    "extra": "money",
    "ehail_fee": "money",
    "total_amount": "money",
    "payment_type": "string",
    "trip_type": "string",
    "congestion_surcharge": "money",
}

_SPARK_TYPE = {"zone": "int", "money": "double"}


@dataclass(frozen=True)
class DriftRules:
    """Parameters of the ingestion. min_share: share of values a kind needs;
    key: the field that names a trip; min_shared, min_agree: shared trips and
    agreeing share that let two names count as one field without ``aliases``."""

    target: dict[str, str] = field(default_factory=lambda: dict(TARGET))
    aliases: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(ALIASES))
    key: str = "trip_ref"
    min_share: float = 0.9
    min_shared: int = 4
    min_agree: float = 0.8

    def logical(self, c: Column) -> Column:
        pairs = [F.lit(x) for k, names in sorted(self.aliases.items()) for a in names for x in (a, k)]
        return F.coalesce(F.create_map(*pairs)[c], c) if pairs else c


def _name(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))


def _split(line: Column, sep: Column) -> Column:
    """Values of a delimited line; quoted values may hold the separator and doubled quotes."""
    s = F.concat(F.lit("\\Q"), sep, F.lit("\\E"))
    pattern = F.concat(s, F.lit('(?:"(?:[^"]|"")*"(?='), s, F.lit("|$)|(?:(?!"), s, F.lit(").)*)"))
    cut = F.regexp_extract_all(F.concat(sep, line), pattern, F.lit(0))
    plain = F.split(line, s)

    def value(x: Column) -> Column:
        v = F.substring(x, 2, 1 << 30)
        quoted = (F.length(v) > 1) & v.startswith('"') & v.endswith('"')
        return F.when(quoted, F.replace(F.substr(v, F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"'))).otherwise(v)

    return F.when(line.contains('"'), F.transform(cut, value)).otherwise(plain)


def parse_lines(raw: DataFrame, files: DataFrame) -> DataFrame:
    """A row a line, written once: file_id, line_no, head (a csv header), names, vals (null if the line is broken), line (of broken lines only).

    names and vals stand in reverse order, so that the first of equal names is
    the one that counts. The files' side of the joins is metadata; the lines'
    side is split by Spark's skew join if one file holds most lines.
    """
    f = files.select("file_id", "file_format", "separator").where("file_id is not null").dropDuplicates(["file_id"])
    csv = F.col("file_format") == "csv"
    head = raw.where(F.col("line_no") == 1).select("file_id", "line").join(f.where(csv), "file_id").groupBy("file_id").agg(F.min("line").alias("line"), F.min("separator").alias("separator"))
    head = head.select("file_id", F.reverse(F.transform(_split(F.col("line"), F.col("separator")), _name)).alias("names"))
    r = raw.select("file_id", "line_no", "line").join(f.join(head, "file_id", "left"), "file_id", "left")
    is_head = F.coalesce(csv & (F.col("line_no") == 1), F.lit(False))
    vals = F.when(csv & ~is_head & (F.trim("line") != ""), F.reverse(_split(F.col("line"), F.col("separator"))))
    js = F.when((F.col("file_format") == "jsonl") & F.col("line").rlike(r"^\s*\{.*\}\s*$"), F.map_entries(F.from_json("line", "map<string,string>")))
    r = r.withColumns({"head": is_head, "vals": vals, "js": js})
    whole = F.size("vals") == F.size("names")
    r = r.withColumns({
        "names": F.when(is_head | whole, F.col("names")).when(F.col("js").isNotNull(), F.reverse(F.transform("js", lambda e: _name(e["key"])))),
        "vals": F.when(whole, F.col("vals")).when(F.col("js").isNotNull(), F.reverse(F.transform("js", lambda e: e["value"]))),
    })
    return materialise(r.select("file_id", "line_no", "head", "names", "vals", F.when(F.col("vals").isNull(), F.col("line")).alias("line")))


def _cast(v: Column, kind: str, cents: Column | None = None) -> Column:
    """A value in the target's type, null if it can't be; cents: whether a bare integer is an amount in cents."""
    t = F.trim(v)
    if kind == "money":
        amount = F.regexp_extract(t, r"^(?:\$|amt )?\s*([+-]?[0-9]+(?:\.[0-9]*)?)\s*(?:USD)?$", 1).try_cast("double")
        return amount if cents is None else F.when(cents & t.rlike(r"^[+-]?[0-9]+$"), amount / 100).otherwise(amount)
    if kind == "zone":
        return F.regexp_extract(t, r"^[Zz]?0*([0-9]{1,9})(?:\.0+)?$", 1).try_cast("int")
    if kind == "int":
        return F.regexp_extract(t, r"^([+-]?[0-9]{1,9})(?:\.0+)?$", 1).try_cast("int")
    if kind == "timestamp_ntz":
        seconds = F.timestamp_seconds(F.when(t.rlike(r"^[0-9]{1,11}$"), t).try_cast("bigint")).cast("timestamp_ntz")
        return F.coalesce(seconds, F.replace(t, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"))
    if kind == "string":
        return t
    return t.try_cast(kind)


def field_kinds(parsed: DataFrame, rules: DriftRules = DriftRules()) -> DataFrame:
    """file_id, field, kind (null: no values), values. Pre-aggregated on the map side: a file's lines never gather in one task."""
    # a header's names have no values: the zip pads with nulls
    zipped = F.arrays_zip(F.col("names").alias("field"), F.coalesce("vals", F.array().cast("array<string>")).alias("value"))
    cells = parsed.where("names is not null").select("file_id", F.explode(zipped).alias("e"))
    cells = cells.select("file_id", "e.field", value_kind("e.value").alias("kind"))
    kinds = ("integer", "decimal", "timestamp", "text")
    n = cells.groupBy("file_id", "field").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds))
    total = sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))
    best = F.greatest(*kinds)
    sure = F.lit(None).cast("string")
    for k in kinds:
        sure = F.when((F.col(k) == best) & (F.col(k) >= rules.min_share * total), k).otherwise(sure)
    return n.select("file_id", "field", F.when(total > 0, sure).alias("kind"), total.alias("values"))


def conform(parsed: DataFrame, rules: DriftRules = DriftRules(), kinds: DataFrame | None = None) -> DataFrame:
    """One consistent table: file_id, line_no, the target's columns, and ``_rescued``.

    ``_rescued`` is JSON with the fields outside the target and the values
    that the target's type can't hold, under the names they came with; null
    if there are none. kinds (as of field_kinds) tells which money fields of a
    file are in cents. No shuffle of the lines beyond the join to the files.
    """
    kinds = field_kinds(parsed, rules) if kinds is None else kinds
    coins = kinds.where("kind = 'integer'").groupBy("file_id").agg(F.collect_set("field").alias("_coins"))
    own = F.transform("names", rules.logical)  # the field of each name
    d = parsed.where("not head").withColumn("_own", own).join(coins, "file_id", "left")
    d = d.withColumn("vals", F.transform("vals", lambda v: F.when(~is_absent(v), v)))
    typed, left = {}, {}
    for name, kind in rules.target.items():
        at = F.nullif(F.array_position("_own", F.lit(name)), F.lit(0)).cast("int")
        typed[name] = _cast(F.try_element_at("vals", at), kind, F.coalesce(F.array_contains("_coins", F.try_element_at("names", at)), F.lit(False)))
        left[name] = (at, F.try_element_at("vals", at))
    d = d.withColumns({f"_t_{k}": v for k, v in typed.items()})
    unheld = F.array_compact(F.array(*(F.when(v.isNotNull() & F.col(f"_t_{k}").isNull(), at) for k, (at, v) in left.items())))
    outside = F.filter(F.transform("_own", lambda o, i: F.when(~o.isin(*rules.target), i + 1)), lambda i: i.isNotNull())
    d = d.withColumn("_at", F.filter(F.concat(unheld, outside), lambda i: F.try_element_at(F.col("vals"), i).isNotNull()))
    keys = F.array_distinct(F.transform("_at", lambda i: F.element_at("names", i)))
    rescued = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at("vals", F.array_position("names", k).cast("int"))))
    return d.select(
        "file_id",
        "line_no",
        *(F.col(f"_t_{k}").cast(_SPARK_TYPE.get(t, t)).alias(k) for k, t in rules.target.items()),
        F.when(F.col("vals").isNull(), F.to_json(F.create_map(F.lit("_line"), F.coalesce("line", F.lit("")))))
        .when(F.size("_at") > 0, F.to_json(rescued))
        .alias("_rescued"),
    )


def promote(table: DataFrame, fields: dict[str, str], aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Replay rescued values into new typed columns.

    fields: approved name -> type as in the target. Values the type can't
    hold stay in ``_rescued``; the others leave it. A bare integer is a whole
    amount. A name that is a column already is filled only where it is null.
    """
    for name, kind in fields.items():
        names = [name, *(ALIASES if aliases is None else aliases).get(name, ())]
        m = F.from_json("_rescued", "map<string,string>")
        raw = F.coalesce(*(m[n] for n in names))
        value = _cast(raw, kind)
        rest = F.map_filter(m, lambda k, v: ~k.isin(*names) | _cast(v, kind).isNull())
        old = F.col(name) if name in table.columns else F.lit(None)
        table = table.withColumns(
            {name: F.coalesce(old, value).cast(_SPARK_TYPE.get(kind, kind)), "_rescued": F.when(F.size(rest) > 0, F.to_json(rest))}
        )
    return table


def _canonical(v: Column) -> Column:
    """A value without its style, to compare a trip's values under two names."""
    digits = F.regexp_extract(v, r"([0-9]+(?:\.[0-9]+)?)", 1)
    number = F.when(v.rlike(r"^[^0-9]{0,5}[0-9]+(\.[0-9]+)?[^0-9]{0,4}$"), digits.try_cast("double"))
    return F.coalesce(number.cast("string"), F.lower(F.trim(v)))


def schema_changes(parsed: DataFrame, files: DataFrame, rules: DriftRules = DriftRules()) -> DataFrame:
    """file_id, field, change (added, removed, renamed, retyped) against the feed's file before.

    A removed and an added name of one file are matched if the trips that both
    files hold carry the same values under both, the rescued values of an
    unknown name being replayed into the type of the field it may stand for;
    two names that ``rules.aliases`` gives to one field, or to different ones,
    need no values. A name so matched stands for its field in the feed's later
    files.
    """
    order = W.partitionBy("feed").orderBy("delivered_at", "file_id")
    seq = files.where("feed is not null").select("file_id", "feed", F.row_number().over(order).alias("seq"), F.lead("file_id").over(order).alias("next_id"))
    counted = materialise(field_kinds(parsed, rules))  # a row a file and field
    kinds = counted.join(seq, "file_id").select("feed", "seq", "file_id", "next_id", "field", "kind", rules.logical(F.col("field")).alias("logical"))
    cur = kinds.select("feed", "file_id", "field", "kind", "logical")
    prev = kinds.where("next_id is not null").select("feed", F.col("next_id").alias("file_id"), F.col("file_id").alias("before"), F.col("field").alias("old"), F.col("kind").alias("p_kind"), "logical")
    open_ = [x.join(y.select("file_id", "logical"), ["file_id", "logical"], "left_anti") for x, y in ((prev, cur), (cur.join(prev.select("file_id").distinct(), "file_id"), prev))]
    listed = lambda c: F.col(c).isin(*_listed(rules))
    offer = open_[0].select("file_id", "feed", "before", "old").join(open_[1].select("file_id", F.col("field").alias("new")), "file_id").where(~(listed("old") & listed("new")))
    known = F.when(listed("old"), rules.logical(F.col("old"))).when(listed("new"), rules.logical(F.col("new")))
    offer = offer.select("feed", "file_id", "before", "old", "new", known.alias("logical"), F.lit(False).alias("teaches"))
    coded = [k for k, t in rules.target.items() if t == "string"]
    teach = cur.where(F.col("logical").isin(*coded)).join(prev, ["feed", "file_id", "logical"]).where("kind <> p_kind")
    offer = materialise(offer.unionByName(teach.select("feed", "file_id", "before", "old", F.col("field").alias("new"), "logical", F.lit(True).alias("teaches"))))
    if offer.where("not teaches").isEmpty():  # no name is left to explain: no need to read the lines again
        moved = offer.select("feed", "file_id", "old", "new", F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("agree")).limit(0)
    else:
        moved = _moved(parsed, counted, offer, rules)
    fields = seq.select("feed", "seq", "file_id").join(kinds.select("file_id", "field", "kind"), "file_id", "left")
    return fields.groupBy("feed").cogroup(moved.groupBy("feed")).applyInPandas(_walk(rules), "file_id bigint, field string, change string")


def _listed(rules: DriftRules) -> list[str]:
    return [*rules.target, *rules.aliases, *(a for v in rules.aliases.values() for a in v)]


def _walk(rules: DriftRules):
    """The changes of one feed's files in their order: rows are names and kinds, never values."""
    own = {x: x for x in (*rules.target, *rules.aliases)} | {a: k for k, v in rules.aliases.items() for a in v}
    real = set(own.values())

    def walk(fields: pd.DataFrame, moved: pd.DataFrame) -> pd.DataFrame:
        hints: dict[int, list] = {}
        for file_id, agree, n, old, new in sorted(zip(*(moved[c].tolist() for c in ("file_id", "agree", "n", "old", "new"))), key=lambda r: (-r[1], -r[2], r[3], r[4])):
            hints.setdefault(file_id, []).append((old, new))
        out, role, had, prev = [], {}, {}, None
        of = lambda x: own.get(x) or role.get(x, x)
        rows = sorted(zip(*(fields[c].tolist() for c in ("seq", "file_id", "field", "kind"))), key=lambda r: r[0])
        for (_, file_id), g in groupby(rows, key=lambda r: r[:2]):
            now = {f: k if isinstance(k, str) else None for _, _, f, k in g if isinstance(f, str)}
            origin = {f: f for f in now if f in had}
            if prev is not None:
                gone = {f: of(f) for f in sorted(had.keys() - now.keys())}
                for f in sorted(now.keys() - had.keys()):
                    old = next((x for x, name in gone.items() if name == of(f)), None)
                    if old is not None:
                        origin[f] = old
                        del gone[old]
                for old, new in hints.get(file_id, ()):
                    a, b = of(old), of(new)
                    if old not in gone or new in origin or (a in real and b in real):
                        continue
                    origin[new] = old
                    del gone[old]
                    root = b if b in real else a
                    role.update({x: root for x, r in role.items() if r in (a, b)} | {x: root for x in (old, new) if x not in own})
                out += [(file_id, f, "removed") for f in gone]
                out += [(file_id, f, "added") for f in now if f not in origin]
                out += [(file_id, f, "renamed") for f, old in origin.items() if f != old]
                out += [(file_id, f, "retyped") for f, old in origin.items() if now[f] and had[old] and now[f] != had[old]]
            had = {f: k or had.get(origin.get(f)) for f, k in now.items()}
            prev = file_id
        return pd.DataFrame(out, columns=["file_id", "field", "change"])

    return walk


def _moved(parsed: DataFrame, kinds: DataFrame, offer: DataFrame, rules: DriftRules) -> DataFrame:
    """feed, file_id, old, new, n, agree: the offered names whose values agree over shared trips.

    Only the offered names of the files that have an offer are looked up, in the
    parsed table itself: those outside the target are what ``conform`` rescues.
    Values agree if they are the same but for style, if the rescued one,
    replayed into the field's type, is the field's, or if the files
    that retype the field under listed names turn one into the other (1 and
    standard). A name also stands for a field if the shared trips of all feeds
    together say so and the file's own don't speak against it.
    """
    own = lambda c: rules.logical(F.col(c))
    sides = offer.select("file_id", F.col("new").alias("name")).unionByName(offer.select(F.col("before").alias("file_id"), F.col("old").alias("name"))).distinct()
    wanted = sides.groupBy("file_id").agg(F.collect_set("name").alias("_wanted"))  # at most a file's names
    ref = F.try_element_at("vals", F.nullif(F.array_position("names", F.lit(rules.key)), F.lit(0)).cast("int"))
    lines = parsed.where("not head and vals is not null").join(wanted, "file_id").select("file_id", _cast(ref, rules.target[rules.key]).alias("ref"), "_wanted", "names", "vals").where("ref is not null")
    cell = lines.select("file_id", "ref", "names", "vals", F.explode("_wanted").alias("name"))
    cell = cell.select("file_id", "ref", "name", F.try_element_at("vals", F.nullif(F.array_position("names", F.col("name")), F.lit(0)).cast("int")).alias("value")).where(~is_absent("value"))
    coins = kinds.where("kind = 'integer'").select("file_id", F.col("field").alias("name"), F.lit(True).alias("cents"))
    cell = materialise(cell.join(coins, ["file_id", "name"], "left").withColumn("cents", F.coalesce("cents", F.lit(False))))  # read from both sides
    after = cell.withColumnsRenamed({"name": "new", "value": "v_new", "cents": "c_new"})
    ahead = cell.withColumnsRenamed({"file_id": "before", "name": "old", "value": "v_old", "cents": "c_old"})
    both = offer.join(after, ["file_id", "new"]).join(ahead, ["before", "old", "ref"]).withColumns({"a": _canonical(F.col("v_old")), "b": _canonical(F.col("v_new"))})
    both = materialise(both)  # a row a shared trip and offered pair
    turned = both.where("teaches and a <> b")
    codes = turned.select("logical", "a", "b").unionByName(turned.select("logical", F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("logical", "a", "b").agg(F.count(F.lit(1)).alias("times"))
    codes = codes.withColumn("share", F.col("times") / F.sum("times").over(W.partitionBy("logical", "a"))).where(F.col("share") >= rules.min_agree).select("logical", "a", "b", F.lit(True).alias("coded"))
    kind = F.create_map(*(F.lit(x) for kv in rules.target.items() for x in kv))[F.col("logical")]
    # the rescued value and the field's own, both in the field's type
    same_typed = F.lit(False)
    for t in ("money", "zone", "timestamp_ntz"):
        same_typed = F.when(kind == t, _cast(F.col("v_old"), t, F.col("c_old")) == _cast(F.col("v_new"), t, F.col("c_new"))).otherwise(same_typed)
    same = (F.col("a") == F.col("b")) | F.coalesce(same_typed, F.lit(False)) | F.coalesce("coded", F.lit(False))
    met = both.where("not teaches").join(codes, ["logical", "a", "b"], "left").withColumn("same", same.cast("double"))
    count = [F.count(F.lit(1)).alias("n"), F.avg("same").alias("agree"), F.count_distinct("b").alias("d")]
    sure = (F.col("n") >= rules.min_shared) & (F.col("agree") >= rules.min_agree) & (F.col("d") > 1)
    here = met.groupBy("file_id", "old", "new").agg(*count).withColumn("sure", sure).drop("d")
    # what all feeds' files say of a name that is in no list: few shared trips in each may be enough together
    listed = lambda c: F.col(c).isin(*_listed(rules))
    learnt = met.where("logical is not null").groupBy(F.when(listed("old"), F.col("new")).otherwise(F.col("old")).alias("name"), "logical").agg(*count).where(sure)
    learnt = learnt.groupBy("name").agg(F.max_by("logical", F.struct("agree", "n", "logical")).alias("field"))
    out = offer.where("not teaches").select("feed", "file_id", "old", "new").distinct().join(here, ["file_id", "old", "new"], "left")
    for c in ("old", "new"):
        out = out.join(learnt.select(F.col("name").alias(c), F.col("field").alias(f"l_{c}")), c, "left").withColumn(f"l_{c}", F.when(listed(c), own(c)).otherwise(F.col(f"l_{c}")))
    told = (F.col("l_old") == F.col("l_new")) & (F.coalesce("agree", F.lit(1.0)) >= 0.5)
    out = out.where(F.coalesce("sure", F.lit(False)) | F.coalesce(told, F.lit(False)))
    return out.select("feed", "file_id", "old", "new", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("agree", F.lit(0.5)).alias("agree"))
