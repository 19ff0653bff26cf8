"""Resolving printed names to people in tiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions import names as N
from rostrum.operators.joins import unique_candidates, unique_prefixes, word_set

#: Tiers in the order in which they are tried; from `corrected` on, a hand-kept list of misread names has its say first.
TIERS = ["hand", "inverted", "direct", "bin_free", "word_set", "word_subset", "prefix", "spelling", "haji_free", "camel_case", "surname"]
#: Words from which on a name is turned around, and its words are looked up as a subset; words of a prefix at least.
REARRANGED, SUBSET, PREFIX = 3, 3, 2


def hand_list(readings: DataFrame, by: list[str], label: str, value: str = "person") -> DataFrame:
    """Rows of the tier `hand` for lookups: printed labels that someone has read; a label with two readings is dropped."""
    return unique_candidates(readings.select(*by, F.lit("hand").alias("tier"), N.lookup_key(F.col(label)).alias("key"), value), [*by, "tier", "key"], value)


def turned_name(name: Column) -> Column:
    """A stored name in the order it is spoken: 'Given Surname' of 'Surname, Given', else the last word first and the first one last."""
    words = F.split(F.trim(name), r"\s+")
    n = F.size(words)
    turned = F.concat_ws(" ", F.slice(words, n, F.lit(1)), F.slice(words, F.lit(2), F.greatest(n - 2, F.lit(0))), F.slice(words, F.lit(1), F.lit(1)))
    return F.coalesce(N.invert_name(name), F.when(n >= REARRANGED, N.strip_title(turned)))


def long_words(key: Column) -> Column:
    """A key's distinct words of two letters and more, sorted."""
    return F.concat_ws(" ", F.array_sort(F.array_distinct(F.filter(F.split(key, r"\s+"), lambda w: F.length(w) > 1))))


def lookups(people: DataFrame, by: list[str], name: str = "name", value: str = "person") -> DataFrame:
    """(by, tier, key, value): all lookup tables as one; a key with several values in a tier is dropped.

    Names stored inverted ('Surname, Given') are looked up in both orders as sets, subsets and
    prefixes; a set's key has the number of words; a subset leaves out one-letter words of names
    of three words and more; prefixes stop one word short of the name.
    """
    n = F.col(name)
    natural = N.invert_name(n)
    key, turned = N.lookup_key(n), N.lookup_key(natural)
    words = lambda k: F.size(F.split(k, r"\s+"))
    last = F.element_at(F.split(F.coalesce(turned, key), r"\s+"), -1)
    # In each stored order: sets, subsets and prefixes.
    forms = people.select(*by, value, F.explode(F.array_distinct(F.array(key, F.coalesce(turned, key)))).alias("_k")).where("_k <> ''")
    of = {"word_set": word_set(F.col("_k")), "word_subset": F.when(words(F.col("_k")) >= SUBSET, long_words(F.col("_k")))}
    sets = forms.select(*by, value, F.explode(F.array(*(F.struct(F.lit(t).alias("tier"), k.alias("key")) for t, k in of.items()))).alias("k"))
    whole = {"direct": key, "bin_free": N.lookup_key(N.strip_bin(n)), "inverted": N.lookup_key(turned_name(n)), "surname": F.when(F.length(last) >= 2, last)}
    rows = people.select(*by, value, F.explode(F.array(*(F.struct(F.lit(t).alias("tier"), k.alias("key")) for t, k in whole.items()))).alias("k"))
    prefixes = unique_prefixes(forms, by, "_k", value, PREFIX).select(*by, F.lit("prefix").alias("tier"), F.col("prefix").alias("key"), value)
    tables = reduce(DataFrame.unionByName, [rows.unionByName(sets).select(*by, "k.tier", "k.key", value), prefixes])
    return unique_candidates(tables.where("key is not null and key <> ''"), [*by, "tier", "key"], value)


def _with_keys(rows: DataFrame, forms: dict[str, Column]) -> DataFrame:
    """rows with columns _<form>_key, _bare, _set and _subset of each form of a name: each is computed once, in steps."""
    rows = rows.withColumns({f"_{f}_key": N.lookup_key(c) for f, c in forms.items()} | {f"_{f}_bare": N.lookup_key(N.strip_bin(c)) for f, c in forms.items()})
    return rows.withColumns({f"_{f}_set": word_set(F.col(f"_{f}_key")) for f in forms} | {f"_{f}_subset": F.when(F.col(f"_{f}_key").isNotNull(), long_words(F.col(f"_{f}_key"))) for f in forms})


def _variants(form: str, sets: bool = True) -> list[tuple[str, Column]]:
    """(table, key) in the order in which a form of a name is looked up; a key that was asked before is not asked again."""
    key, bare = F.col(f"_{form}_key"), F.col(f"_{form}_bare")
    of_sets = [("word_set", F.col(f"_{form}_set")), ("word_subset", F.col(f"_{form}_subset"))] if sets else []
    return [("direct", key), ("bin_free", bare), ("direct", F.when(bare != key, bare)), *of_sets, ("prefix", key)]


def _distinct(labels: DataFrame, by: list[str], label: str, corrections: DataFrame | None) -> DataFrame:
    """(by, label, _fixed) of distinct labels; corrections (printed, name) is a list of misread names."""
    distinct = labels.select(*by, label).where(F.col(label).isNotNull()).distinct()
    if corrections is None:
        return distinct.withColumn("_fixed", F.lit(None).cast("string"))
    fixed = unique_candidates(corrections.select(N.lookup_key(F.col("printed")).alias("_printed"), "name"), ["_printed"], "name")
    return distinct.withColumn("_printed", N.lookup_key(F.col(label))).join(fixed.withColumnRenamed("name", "_fixed"), "_printed", "left")


def _hits(asked: DataFrame, by: list[str], label: str, tries: list[tuple[str, str, Column]], tables: DataFrame) -> DataFrame:
    """Rows (by, label, rank, rule, value): tries are (rule, table, key), in order; one join for all of them."""
    each = F.array(*(F.struct(F.lit(k).alias("rank"), F.lit(rule).alias("rule"), F.lit(t).alias("tier"), key.alias("key")) for k, (rule, t, key) in enumerate(tries)))
    rows = asked.select(*by, label, F.explode(each).alias("k")).select(*by, label, "k.*").where("key is not null and key <> ''")
    return rows.join(tables, [*by, "tier", "key"])


def resolve_tiered(labels: DataFrame, tables: DataFrame, by: list[str], label: str, value: str = "person", corrections: DataFrame | None = None) -> DataFrame:
    """(by, label, value, tier): the hit of the first tier that has one; of a corrected name as of the name itself.

    A name is sought as it is, with one spelling for names that have several, without a mark of
    pilgrimage inside (but then not by its set of words), and parted where a capital follows a
    small letter; a single word may be a surname that one person alone has.
    """
    asked = _distinct(labels, by, label, corrections).withColumn("_name", F.coalesce("_fixed", label))
    name = F.col("_name")
    other = lambda form: F.nullif(form, name)
    forms = {"spelling": other(N.spelling_normalize(name)), "haji_free": other(N.strip_middle_haji(name)), "camel_case": other(F.regexp_replace(name, r"([a-z.])([A-Z])", "$1 $2"))}
    asked = asked.withColumns({f"_{f}": c for f, c in forms.items()})
    asked = _with_keys(asked, {f: F.col(f"_{f}") for f in ("name", *forms)})
    key = F.col("_name_key")
    tries = [("hand", "hand", key), ("inverted", "inverted", key), *((t, t, k) for t, k in _variants("name"))]
    tries += [("spelling", t, k) for t, k in _variants("spelling")] + [("haji_free", t, k) for t, k in _variants("haji_free", sets=False)]
    tries += [("camel_case", "hand", F.col("_camel_case_key")), *(("camel_case", t, k) for t, k in _variants("camel_case")), ("surname", "surname", F.when(~key.contains(" "), key))]
    hits = _hits(asked, by, label, tries, tables)
    return hits.groupBy(*by, label).agg(F.min_by(F.struct(value, F.col("rule").alias("tier")), "rank").alias("_h")).select(*by, label, f"_h.{value}", "_h.tier")


def resolve_strict(labels: DataFrame, tables: DataFrame, by: list[str], label: str, value: str = "person", corrections: DataFrame | None = None) -> DataFrame:
    """(by, label, value, tier) of labels whose hits all agree; tier is the first that hit.

    Asked are the hand list and, for a corrected name, the name as printed and its order turned
    around, the whole name, the inverted one, the one without particles and the set of words.
    Subsets, prefixes and spellings prove nothing here.
    """
    asked = _distinct(labels, by, label, corrections)
    tries = [("hand", "hand", N.lookup_key(F.col(label)))]
    for rule, form in (("hand", F.col("_fixed")), (None, F.col(label)), ("inverted", N.invert_name(F.col(label)))):
        whole, bare = N.lookup_key(form), N.lookup_key(N.strip_bin(form))
        for tier, table, key in (("direct", "direct", whole), ("inverted", "inverted", whole), ("bin_free", "bin_free", bare), ("bin_free", "direct", bare), ("word_set", "word_set", word_set(whole))):
            tries.append((rule or tier, table, F.when(form.isNotNull(), key)))
    found = _hits(asked, by, label, tries, tables).groupBy(*by, label).agg(F.min(value).alias(value), F.max(value).alias("_max"), F.min_by("rule", "rank").alias("tier"))
    return found.where(F.col(value) == F.col("_max")).drop("_max")


#: A bracket that holds a person, as 'Minister for X (Mr A B)': it begins with a title.
_TITLED = r"\(((?:Mr|Mrs|Ms|Mdm|Miss|Dr|Prof|Assoc|Er|Encik|Inche|BG|RAdm)\b[^()]*)\)"


def label_names(labels: DataFrame, terms: DataFrame, roles: DataFrame, non_speakers: list[str], by: str, label: str, day: str) -> DataFrame:
    """(by, label, day, lookup_name, rule) of the distinct printed labels: whom to look up, by the first rule that fits.

    NON_SPEAKER (listed, or it begins with a bracket or an asterisk); CHAIR_NAMED (an office
    with terms that names its holder in brackets); HELD_ON_DAY (the one whose term of the office
    (label, first_day, last_day, holder) holds the day; several or none give no name); ROLE (roles:
    label, by, holder); BRACKET (the last bracket with a title, else what is before the first
    one); NAME.
    """
    from rostrum.operators.joins import holder_on_day

    asked = labels.select(by, label, day).where(F.col(label).isNotNull()).distinct()
    text = N.clean_label(F.col(label))
    inner = F.try_element_at(F.regexp_extract_all("_text", F.lit(_TITLED), F.lit(1)), F.lit(-1))
    bare = F.trim(F.regexp_extract("_text", r"^([^(]*)", 1))
    rows = asked.withColumn("_text", text).withColumn("_office", F.trim(F.regexp_replace("_text", r"\s*\([^()]*\)\s*$", "")))
    offices = F.broadcast(terms.select(F.col("label").alias("_office")).distinct().withColumn("_dated", F.lit(True)))  # a hand-kept list
    rows = rows.join(offices, "_office", "left")
    held = holder_on_day(rows.where("_dated").select("_office", day).distinct(), terms.withColumnRenamed("label", "_office"), ["_office", day], day, "first_day", "last_day", "holder", ["_office"])
    rows = rows.join(held.select("_office", day, F.col("holder").alias("_held")), ["_office", day], "left")
    rows = rows.join(F.broadcast(roles.select(F.col("label").alias("_text"), by, F.col("holder").alias("_role"))), ["_text", by], "left")
    silent = F.col(label).isin(non_speakers) | F.col(label).rlike(r"^[(*]")
    named = F.regexp_extract("_text", r"\(([^()]+)\)\s*$", 1)
    rule = F.when(silent, "NON_SPEAKER").when(F.col("_dated") & (named != ""), "CHAIR_NAMED").when(F.col("_dated"), "HELD_ON_DAY").when(F.col("_role").isNotNull(), "ROLE").when(F.col("_text").contains("("), "BRACKET").otherwise("NAME")
    name = F.when(rule == "CHAIR_NAMED", named).when(rule == "HELD_ON_DAY", F.col("_held")).when(rule == "ROLE", F.col("_role")).when(rule == "BRACKET", F.coalesce(inner, bare)).when(rule == "NAME", F.col("_text"))
    return rows.select(by, label, day, F.nullif(F.trim(name), F.lit("")).alias("lookup_name"), rule.alias("rule"))


def resolve_labels(labels: DataFrame, tables: DataFrame, terms: DataFrame, roles: DataFrame, non_speakers: list[str], by: str, label: str, day: str, value: str = "person") -> DataFrame:
    """(by, label, day, value, rule, tier): the label's name by rule, then the person by tiers."""
    names = label_names(labels, terms, roles, non_speakers, by, label, day)
    hits = resolve_tiered(names.select(by, "lookup_name"), tables, [by], "lookup_name", value)
    return names.join(hits, [by, "lookup_name"], "left").select(by, label, day, value, "rule", "tier")


def context_passes(rows: DataFrame, holders: list[tuple[str, DataFrame, list[str]]], value: str = "person") -> DataFrame:
    """rows with value and linked_by: each pass (name, holders, keys) links rows that are still unlinked.

    A pass's holders are keyed by what the pass knows of a row (a report's chairman by report, a
    deputy by report or sitting, a credited range's person by row); keys with several are refused.
    """
    from rostrum.operators.joins import unique_match_join

    by = F.when(F.col(value).isNotNull(), F.lit("label"))
    out = rows.withColumn("linked_by", by)
    for name, own, keys in holders:
        joined = unique_match_join(out, own.withColumnRenamed(value, "_v"), keys, "_v")
        hit = F.col(value).isNull() & F.col("_v").isNotNull()
        out = joined.withColumns({"linked_by": F.when(hit, F.lit(name)).otherwise(F.col("linked_by")), value: F.coalesce(value, "_v")}).drop("_v")
    return out


def with_fallbacks(labels: DataFrame, group: str, fallbacks: dict[int, list[int]]) -> DataFrame:
    """labels with (asked, priority): the group itself, then those that stand in for it."""
    pairs = [(g, o, k + 1) for g, others in fallbacks.items() for k, o in enumerate(others)]
    more = labels.sparkSession.createDataFrame(pairs, f"{group} int, asked int, priority int")
    own = labels.withColumns({"asked": F.col(group).cast("int"), "priority": F.lit(0)})
    return own.unionByName(labels.join(F.broadcast(more), group).select(own.columns))
