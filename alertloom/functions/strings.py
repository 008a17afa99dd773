"""Column functions on names and tokens, and the skeleton of a reasoning trace."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as v

SEED = "42"
ABSENT = "absent from both records"


def pick(key: Column, salt: str, n: Column | int, seed: str = SEED) -> Column:
    """A number from 0 to n - 1 that depends on key, salt and seed alone; it stands for every random choice."""
    digest = F.substring(F.md5(F.concat(key, F.lit(f"|{salt}|{seed}"))), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(n) if isinstance(n, int) else n)


def pick_from(values: list[str], key: Column, salt: str, seed: str = SEED) -> Column:
    return F.get(words(values), pick(key, salt, len(values), seed).cast("int"))


def words(values) -> Column:
    """A literal array of strings; from one text, which is folded once, as each literal by itself is a call to the JVM."""
    return F.from_json(F.lit(json.dumps([str(x) for x in values])), "array<string>")


def lookup(table: dict, key: Column) -> Column:
    """A literal map of curated entries (at most a few hundred); null where the key isn't one."""
    one = next(iter(table.values()))
    kind = "array<string>" if isinstance(one, list) else "long" if isinstance(one, int) else "double" if isinstance(one, float) else "string"
    found = F.try_element_at(F.from_json(F.lit(json.dumps({str(k): x for k, x in table.items()})), f"map<string,{kind}>"), key.cast("string"))
    return found.cast("int") if kind == "long" else found


def tokens(name: Column) -> Column:
    return F.filter(F.split(name, r"(?U)\s+"), lambda t: t != "")


def joined(array: Column) -> Column:
    return F.array_join(array, " ")


def last(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def before_last(array: Column) -> Column:
    return F.slice(array, 1, F.greatest(F.size(array) - 1, F.lit(0)))


def middle(array: Column) -> Column:
    return F.slice(array, 2, F.greatest(F.size(array) - 2, F.lit(0)))


def without(array: Column, index: Column) -> Column:
    return F.filter(array, lambda x, i: i != index)


def with_at(array: Column, index: Column, value: Column) -> Column:
    return F.transform(array, lambda x, i: F.when(i == index, value).otherwise(x))


def with_value(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value made once however often then names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 2**31 - 1)))


def trimmed_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


@cache
def _decomposed() -> tuple[str, str, str]:
    """Letters that become one ASCII letter, these letters, and a map (as JSON) of those that become several; of all of Unicode."""
    source, target, longer = [], [], {}
    for code in range(0x80, 0x110000):
        c = chr(code)
        if unicodedata.decomposition(c) and not 0xD800 <= code < 0xE000:
            ascii_form = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
            if len(ascii_form) == 1:
                source.append(c)
                target.append(ascii_form)
            elif ascii_form:
                longer[c] = ascii_form
    return "".join(source), "".join(target), json.dumps(longer)


def strip_marks(c: Column) -> Column:
    """ASCII part of the compatibility decomposition; letters without one vanish."""
    source, target, longer = _decomposed()
    other = r"[^\x00-\x7F]"

    def spelled(text: Column) -> Column:
        """With what the letters that are left become; few names have any."""
        table = F.from_json(F.lit(longer), "map<string,string>")
        letters = F.split(F.regexp_replace(text, f"({other})", "\x00$1\x00"), "\x00")
        return F.regexp_replace(F.array_join(F.transform(letters, lambda x: F.coalesce(F.when(x.rlike(other), F.try_element_at(table, x)), x)), ""), other, "")

    plain = F.transform(F.array(F.translate(c, source, target)), lambda t: F.when(t.rlike(other), spelled(t)).otherwise(t))
    return F.when(c.rlike(other), F.get(plain, F.lit(0))).otherwise(c)


def folded(c: Column) -> Column:
    return F.lower(strip_marks(c))


def differing(a: Column, b: Column) -> Column:
    """Positions at which two arrays differ in lower case, as far as the shorter reaches."""
    same = F.zip_with(F.slice(a, 1, F.least(F.size(a), F.size(b))), F.slice(b, 1, F.least(F.size(a), F.size(b))), lambda x, y: F.lower(x) == F.lower(y))
    return F.array_compact(F.transform(same, lambda s, i: F.when(~s, i)))


def quoted(c: Column) -> Column:
    """As a string is shown in quotes: single ones unless it holds one and no double one."""
    plain = F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'))).when(~c.contains("'"), F.concat(F.lit("'"), F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"))).otherwise(plain)


def says(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def walk_note(client: Column, hit: Column) -> Column:
    return (
        F.when(client.isNull() & hit.isNull(), ABSENT)
        .when(client == hit, says("'", client, "' matches exactly"))
        .when(client.isNull(), says("absent from the client record, recorded as '", hit, "' in the hit"))
        .when(hit.isNull(), says("'", client, "' present in the client record, absent from the hit"))
        .otherwise(says("'", client, "' recorded as '", hit, "'"))
    )


def walk_middle(client: Column, hit: Column) -> Column:
    """The middle note of two token arrays of equal length."""
    a, b = middle(client), middle(hit)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), ABSENT)
        .when(a == b, says(quoted(joined(a)), " matches exactly"))
        .when((F.size(a) == 1) & (F.size(b) == 1), walk_note(F.get(a, F.lit(0)), F.get(b, F.lit(0))))
        .otherwise(says("client middle span '", joined(a), "' recorded as '", joined(b), "'"))
    )


def compose(client: Column, hit: Column, given: Column, mid: Column, surname: Column, boundary: Column, principle: Column, code: Column, decision: Column) -> Column:
    return says("Client '", client, "' vs hit '", hit, "'. Given: ", given, ". Middle: ", mid, ". Surname: ", surname, ". ", boundary, " ", principle, " ", closure(code, decision))


def closure(code: Column, decision: Column) -> Column:
    return says("Therefore: ", code, " -> ", decision, ".")


def overlap(client: Column, hit: Column) -> Column:
    """Words of the hit that the client has too, each once, in the hit's order and casing; the whole hit if there are none."""
    word = F.lit(r"(?U)\b\w+\b")

    def shared(mine: Column, theirs: Column, lower: Column) -> Column:
        return F.filter(theirs, lambda _, i: F.array_contains(mine, F.get(lower, i)) & (F.array_position(lower, F.get(lower, i)) == i + 1))

    found = with_value(F.regexp_extract_all(F.lower(client), word, F.lit(0)), lambda mine: with_value(F.regexp_extract_all(hit, word, F.lit(0)), lambda theirs: with_value(F.transform(theirs, F.lower), lambda lower: shared(mine, theirs, lower))))
    return with_value(found, lambda once: F.when(F.size(once) > 0, joined(once)).otherwise(hit))


def label_of(code: Column) -> Column:
    return F.coalesce(lookup(v.LABELS, code), F.lit("Unknown disposition code"))


def decision_of(code: Column) -> Column:
    return lookup(v.DECISIONS, code)
