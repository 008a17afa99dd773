"""The queries again as DuckDB SQL, written apart from the DataFrame code to check it."""

from __future__ import annotations

from .functions import vocab as v

# Fixed values of the derived client pool.
GIVEN = "Daniel,Daniela,José,Carlos,Khalid,Mohammed,Omar,Wei,Priya,Jean-Paul,Ji-woo,Jürgen,Kofi,Anna,Ivan,Sergei,Martina,Björn,Ali,Hiroshi,Min-jun,Amara,Renée".split(",")
SURNAME = "Smith,Zhang,Rossi,Al-Fassi,Müller,Okafor,Johnson,Haddad,García,Osei,Murray,Dvořák,Khan,Hoffman,Li,Santos,Kim,Patel,Ivanov".split(",")
MIDDLE = "Petrovich,Maria,Kumar,Hassan,Angel,Chen,Lee".split(",")




def lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def arr(xs) -> str:
    return "[" + ", ".join(lit(x) if isinstance(x, str) else str(x) for x in xs) + "]"


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(lit(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {columns}"


def toks(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def join(a: str) -> str:
    return f"array_to_string({a}, ' ')"


def cap(w: str) -> str:
    return f"(upper({w}[1]) || lower({w}[2:]))"


def strip(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def fold(x: str) -> str:
    return f"lower({strip(x)})"


def mapping(table: dict) -> str:
    return f"MAP {{{', '.join(f'{lit(k)}: {lit(x) if isinstance(x, str) else arr(x) if isinstance(x, list) else x}' for k, x in table.items())}}}"


def get(table: dict, key: str) -> str:
    return f"{mapping(table)}[{key}]"


def pick(key: str, salt: str, n: int) -> str:
    return f"(('0x' || substr(md5({key} || {lit(f'|{salt}|42')}), 1, 8))::BIGINT % {n})"


def worded(kind: str, code: str, key: str = "client_name || '|' || variant_ix") -> str:
    xs = v.WORDING[kind]
    return f"{arr(xs)}[{pick(key, f'{code}/{kind}', len(xs))} + 1]"


def note(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN '''' || {a} || ''' matches exactly' ELSE '''' || {a} || ''' recorded as ''' || {b} || '''' END"


def mid_note(t: str, h: str) -> str:
    a, b = f"{t}[2:-2]", f"{h}[2:-2]"
    return (
        f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 'absent from both records' WHEN {a} = {b} THEN '''' || {join(a)} || ''' matches exactly' "
        f"WHEN len({a}) = 1 AND len({b}) = 1 THEN {note(f'{t}[2]', f'{h}[2]')} ELSE 'client middle span ''' || {join(a)} || ''' recorded as ''' || {join(b)} || '''' END"
    )


AB = "'absent from both records'"
POOL = f"""pool AS (SELECT c_custkey AS k, {arr(GIVEN)}[c_custkey % 23 + 1] || ' ' ||
  CASE WHEN c_custkey % 12 = 0 THEN substr('{v.ALPHABET}', CAST((c_custkey // 12) % 26 AS INTEGER) + 1, 1) || '. '
    WHEN c_custkey % 3 = 0 THEN {arr(MIDDLE)}[(c_custkey // 3) % 7 + 1] || ' ' ELSE '' END ||
  {arr(SURNAME)}[(7 * c_custkey + 3) % 19 + 1] AS client_name FROM customer),
clients AS (SELECT DISTINCT client_name FROM pool),
ct AS (SELECT client_name, {toks('client_name')} AS t FROM clients)"""
RAW = f"""{POOL}, pt AS (SELECT k, client_name AS n, {toks('client_name')} AS t FROM pool),
raws AS (SELECT k, CASE k % 6 WHEN 0 THEN upper(t[-1]) || ', ' || {join('t[1:-2]')} WHEN 1 THEN 'Dr. ' || n || ' Jr.' WHEN 2 THEN lower(n)
  WHEN 3 THEN n || ' Trading LLC' WHEN 4 THEN '  "' || n || '" ' ELSE n END AS raw FROM pt)"""
PAIRS = f"""{POOL}, pp AS (SELECT a.k, a.client_name, {toks('a.client_name')} AS t, b.client_name AS other FROM pool a JOIN pool b ON b.k = a.k + 1),
pairs AS (SELECT k, client_name, CASE k % 7 WHEN 0 THEN client_name WHEN 1 THEN {join('list_concat([t[-1]], t[1:-2])')} WHEN 2 THEN client_name || 'e'
  WHEN 3 THEN replace(client_name, '-', ' ') WHEN 4 THEN {join('t[1:-2]')} || ' Osei' WHEN 5 THEN t[1] || ' ' || t[-1] ELSE other END AS hit_name,
  {arr([*v.CODES, 'X'])}[(k // 7) % 14 + 1] AS disposition_code FROM pp),
p AS (SELECT *, CASE WHEN disposition_code IN ({', '.join(map(lit, v.TRUE_POSITIVE))}) THEN '{v.ESCALATE}' ELSE '{v.DISQUALIFY}' END AS decision,
  {toks('client_name')} AS c, {toks('hit_name')} AS h FROM pairs),
pd AS (SELECT *, CASE WHEN len(c) = 0 THEN [] ELSE list_filter(range(1, least(len(c), len(h)) + 1), lambda i: lower(c[i]) <> lower(h[i])) END AS d FROM p)"""


def entity(x: str) -> str:
    return f"list_has_any(regexp_extract_all(upper({x}), '\\b[A-Za-z]+\\b'), {arr(v.ENTITY_WORDS)})"


def inverted(x: str) -> str:
    return f"CASE WHEN contains({x}, ',') THEN trim(substr({x}, strpos({x}, ',') + 1)) || ' ' || trim(substr({x}, 1, strpos({x}, ',') - 1)) ELSE {x} END"


def untitled(x: str) -> str:
    key = "lower(trim(regexp_replace(t, '[.,]', '', 'g')))"
    return join(f"list_filter({toks(x)}, lambda t: {key} <> '' AND NOT list_contains({arr(v.HONORIFICS)}, {key}))")


def cased(a: str) -> str:
    one = "(upper(w) = w AND lower(w) <> w) OR (lower(w) = w AND upper(w) <> w)"
    parts = f"array_to_string(list_transform(string_split(w, '-'), lambda q: {cap('q')}), '-')"
    return f"list_transform({a}, lambda w: CASE WHEN contains(w, '-') THEN {parts} WHEN list_contains({arr(v.PARTICLES)}, lower(w)) OR {one} THEN {cap('w')} ELSE w END)"


def mutation(code: str, hits: str, match: str, given: str, mid: str, surname: str, boundary: str, principle: str, extra: str = "") -> str:
    """hits: SELECT of client_name, t, h (token lists), variant_ix and what the notes use, from ct."""
    thinking = f"""'Client ''' || client_name || ''' vs hit ''' || hit_name || '''. Given: ' || {given} || '. Middle: ' || {mid} || '. Surname: ' || {surname}
    || '. ' || {boundary} || ' ' || {worded(principle, code)} || ' Therefore: {code} -> {v.DECISIONS[code]}.'"""
    return f"WITH {POOL}{extra}, m0 AS ({hits}), m AS (SELECT *, {join('h')} AS hit_name FROM m0) SELECT '{code}' AS code, client_name, CAST(variant_ix AS BIGINT) AS variant_ix, hit_name, {match} AS matching_text, {thinking} AS thinking FROM m"


def walked(code: str, hits: str, match: str, boundary: str, principle: str = "PRINCIPLE_TP_IDENTITY", more: str = "", extra: str = "") -> str:
    surname = f"({note('t[-1]', 'h[-1]')})"
    return mutation(code, hits, match, f"({note('t[1]', 'h[1]')})", f"({mid_note('t', 'h')})", f"{surname} || {more}" if more else surname, boundary, principle, extra)


ENDS = "t[1] || ' ' || t[-1]"
SAME0, SAME9 = "'''' || t[1] || ''' matches exactly'", "'''' || t[-1] || ''' matches exactly'"


def swapped(table: dict, position: str) -> str:
    """Client names joined with a curated list on the token at `position` (ct[...])."""
    rows = [(k, x, n) for k, xs in table.items() for n, x in enumerate(xs)]
    return values(rows, "f(key, form, n)")


MUTATIONS = {
    "mut_exact": mutation("DISP_EXACT_NAME_MATCH", "SELECT client_name, t, t AS h, 0 AS variant_ix FROM ct", "client_name", SAME0, f"CASE WHEN len(t) > 2 THEN '''' || {join('t[2:-2]')} || ''' matches exactly' ELSE {AB} END", SAME9, worded("BOUNDARY_EXACT_MATCH", "DISP_EXACT_NAME_MATCH"), "PRINCIPLE_ANALYST_REVIEW"),
    "mut_order_swap": walked("DISP_TOKEN_ORDER_SWAP", "SELECT client_name, t, list_concat([t[-1]], t[1:-2]) AS h, 0 AS variant_ix FROM ct", join("t"), f"'The variation is ' || CASE WHEN len(t) = 2 THEN 'reversal of first name and family name order' ELSE 'placement of the family name at the beginning of the name' END || ' under ' || {worded('ORDER_MECHANISMS', 'DISP_TOKEN_ORDER_SWAP')} || '; ' || {worded('BOUNDARY_TOKEN_ORDER_SWAP', 'DISP_TOKEN_ORDER_SWAP')}"),
    "mut_middle_abbrev": mutation("DISP_MIDDLE_NAME_ABBREVIATED", "SELECT client_name, t, list_concat(list_concat([t[1]], [t[2][1] || '.']), t[3:]) AS h, 0 AS variant_ix FROM ct WHERE len(t) >= 3 AND length(t[2]) > 2", ENDS, SAME0, f"'''' || t[2] || ''' shortened to initial ''' || h[2] || ''' (' || {worded('MIDDLE_ABBREV_MECHANISMS', 'DISP_MIDDLE_NAME_ABBREVIATED')} || ')'", SAME9, worded("BOUNDARY_MIDDLE_ABBREVIATED", "DISP_MIDDLE_NAME_ABBREVIATED"), "PRINCIPLE_TP_IDENTITY"),
    "mut_middle_expand": mutation("DISP_MIDDLE_INITIAL_EXPANDED", f"SELECT client_name, t, list_concat([t[1], o.x], t[3:]) AS h, o.n AS variant_ix FROM ct, {values([(x, n) for n, x in enumerate(v.MIDDLE_NAMES)], 'o(x, n)')} WHERE len(t) >= 3 AND length(t[2]) <= 2", ENDS, SAME0, f"'middle initial ''' || t[2] || ''' spelled out as ''' || h[2] || ''' (' || {worded('MIDDLE_EXPAND_MECHANISMS', 'DISP_MIDDLE_INITIAL_EXPANDED')} || ')'", SAME9, worded("BOUNDARY_MIDDLE_EXPANDED", "DISP_MIDDLE_INITIAL_EXPANDED"), "PRINCIPLE_TP_IDENTITY"),
    "mut_middle_omit": mutation("DISP_MIDDLE_NAME_OMITTED", f"SELECT client_name, t, list_concat([t[1]], t[3:]) AS h, 0 AS variant_ix FROM ct WHERE len(t) >= 3 UNION ALL SELECT client_name, t, [t[1], o.x || '.', t[2]] AS h, o.n FROM ct, {values([(x, n) for n, x in enumerate(v.ALPHABET)], 'o(x, n)')} WHERE len(t) = 2", ENDS, SAME0, f"CASE WHEN len(t) > 2 THEN 'middle name ''' || t[2] || ''' omitted from the hit (' ELSE 'middle initial ''' || h[2] || ''' present only in the hit (' END || {worded('OMISSION_MECHANISMS', 'DISP_MIDDLE_NAME_OMITTED')} || ')'", SAME9, worded("BOUNDARY_MIDDLE_OMITTED", "DISP_MIDDLE_NAME_OMITTED"), "PRINCIPLE_TP_IDENTITY"),
    "mut_middle_conflict": mutation("DISP_MIDDLE_NAME_CONFLICT", f"SELECT client_name, t, CASE WHEN len(t) > 2 THEN list_concat([t[1], o.x], t[3:]) ELSE [t[1], o.x, t[2]] END AS h, o.n AS variant_ix FROM ct, {values([(x, n) for n, x in enumerate(v.MIDDLE_NAMES)], 'o(x, n)')} WHERE len(t) = 2 OR lower(o.x) <> lower(t[2])", ENDS, SAME0, f"CASE WHEN len(t) > 2 THEN 'conflicting middle name ''' || h[2] || ''' replacing ''' || t[2] || ''' (' || {worded('MIDDLE_ABBREV_MECHANISMS', 'DISP_MIDDLE_NAME_CONFLICT')} || ')' ELSE 'introduction of a distinct middle name ''' || h[2] || ''' (' || {worded('OMISSION_MECHANISMS', 'DISP_MIDDLE_NAME_CONFLICT')} || ')' END", SAME9, worded("BOUNDARY_MIDDLE_CONFLICT", "DISP_MIDDLE_NAME_CONFLICT"), "PRINCIPLE_FP_DISTINCT"),
    "mut_surname_swap": mutation("DISP_SURNAME_CONFLICT", f"SELECT client_name, t, list_concat(t[1:-2], [o.x]) AS h, o.n AS variant_ix FROM ct, {values([(x, n) for n, x in enumerate(v.SURNAMES)], 'o(x, n)')} WHERE lower(o.x) <> lower(t[-1])", join("t[1:-2]"), f"'''' || {join('t[1:-2]')} || ''' matches exactly'", AB, "'''' || t[-1] || ''' recorded as ''' || h[-1] || ''''", worded("BOUNDARY_SURNAME_CONFLICT", "DISP_SURNAME_CONFLICT"), "PRINCIPLE_FP_DISTINCT"),
    "mut_phonetic": walked(
        "DISP_PHONETIC_SURNAME_DIVERGENCE",
        f"""SELECT client_name, t, list_concat(t[1:-2], string_split(x, ' ')) AS h, n AS variant_ix, x AS new, how FROM (
        SELECT client_name, t, unnest(forms) AS x, unnest(range(len(forms))) AS n, how FROM (SELECT client_name, t, CASE WHEN {get(v.PHONETIC, 'lower(t[-1])')} IS NOT NULL THEN 'phonetic variation of surname from ''' ELSE 'surname substitution from ''' END AS how,
        coalesce({get(v.PHONETIC, 'lower(t[-1])')}, CASE WHEN t[-1] LIKE '%son' THEN [t[-1][:-4] || 'sen'] WHEN t[-1] LIKE '%y' THEN [t[-1][:-2] || 'ey'] WHEN contains(lower(t[-1]), 'ff') THEN [regexp_replace(t[-1], '[fF]{{2}}', 'ph', 'g')] END,
        list_filter({arr(v.SURNAMES)}, lambda s: lower(s) <> lower(t[-1]))) AS forms FROM ct) a) b""",
        join("t[1:-2]"), worded("BOUNDARY_PHONETIC_DIVERGENCE", "DISP_PHONETIC_SURNAME_DIVERGENCE"), "PRINCIPLE_FP_DISTINCT", "' (' || how || t[-1] || ''' to ''' || new || ''')'",
    ),
    "mut_translit": walked(
        "DISP_TRANSLITERATION_VARIANT",
        f"""SELECT client_name, t, list_concat(list_concat(t[1:pos - 1], [f.form]), t[pos + 1:]) AS h, pos, tok AS old, f.form AS new, (pos - 1) * 10 + f.n AS variant_ix
        FROM (SELECT client_name, t, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM ct) a JOIN {swapped(v.ROMANISED, 'tok')} ON f.key = lower(tok)""",
        join("list_concat(t[1:pos - 1], t[pos + 1:])"), f"'''' || old || ''' rendered as ''' || new || ''' under ' || {worded('TRANSLITERATION_MECHANISMS', 'DISP_TRANSLITERATION_VARIANT')} || '; ' || {worded('BOUNDARY_TRANSLITERATION', 'DISP_TRANSLITERATION_VARIANT')}",
    ),
    "mut_diacritic": walked(
        "DISP_DIACRITIC_STRIPPED",
        f"""SELECT client_name, t, list_concat(list_concat(t[1:pos - 1], [new]), t[pos + 1:]) AS h, pos, tok AS old, new, 0 AS variant_ix FROM (
        SELECT *, row_number() OVER (PARTITION BY client_name ORDER BY rank, pos) AS rn FROM (
          SELECT client_name, t, tok, pos, coalesce(f.rank, 1000) AS rank, coalesce(f.form, {strip('tok')}) AS new
          FROM (SELECT client_name, t, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM ct) a
          LEFT JOIN {values([(a, b, k) for k, (x, y) in enumerate(v.ACCENTED) for a, b in ((x, y), (y, x))], 'f(key, form, rank)')} ON f.key = tok
          WHERE f.key IS NOT NULL OR ({strip('tok')} <> tok AND {strip('tok')} <> '')) b) c WHERE rn = 1""",
        join("list_concat(t[1:pos - 1], t[pos + 1:])"), f"'''' || old || ''' rendered as ''' || new || ''' under ' || {worded('DIACRITIC_MECHANISMS', 'DISP_DIACRITIC_STRIPPED')} || '; ' || {worded('BOUNDARY_DIACRITIC', 'DISP_DIACRITIC_STRIPPED')}",
    ),
    "mut_compound": mutation(
        "DISP_COMPOUND_NAME_RESTRUCTURED",
        f"""SELECT client_name, t, list_concat(list_concat(t[1:pos - 1], string_split(new, ' ')), t[pos + w:]) AS h, pos, w, old, new, 0 AS variant_ix FROM (
        SELECT *, row_number() OVER (PARTITION BY client_name ORDER BY w, rank, pos) AS rn FROM (
          SELECT client_name, t, pos, 1 AS w, tok AS old, f.form AS new, f.rank FROM (SELECT client_name, t, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM ct) a
            JOIN {values([(h, s, k) for k, (h, s) in enumerate(v.COMPOUND)], 'f(key, form, rank)')} ON f.key = tok
          UNION ALL SELECT client_name, t, pos, 2, two, g.form, g.rank FROM (SELECT client_name, t, pos, t[pos] || ' ' || t[pos + 1] AS two FROM (SELECT client_name, t, unnest(range(1, len(t))) AS pos FROM ct) z) y
            JOIN {values([(s, h, k) for k, (h, s) in enumerate(v.COMPOUND) if len(s.split()) == 2], 'g(key, form, rank)')} ON g.key = two) b) c WHERE rn = 1""",
        join("list_concat(t[1:pos - 1], t[pos + w:])"), f"({note('t[1]', 'h[1]')})", f"CASE WHEN len(t) > 2 OR len(h) > 2 THEN ({note(join('t[2:-2]'), join('h[2:-2]'))}) ELSE {AB} END", f"({note('t[-1]', 'h[-1]')})",
        f"'''' || old || ''' recorded as ''' || new || ''' under ' || {worded('COMPOUND_MECHANISMS', 'DISP_COMPOUND_NAME_RESTRUCTURED')} || '; ' || {worded('BOUNDARY_COMPOUND', 'DISP_COMPOUND_NAME_RESTRUCTURED')}", "PRINCIPLE_TP_IDENTITY",
    ),
    "mut_gender": mutation(
        "DISP_GIVEN_NAME_GENDER_VARIANT",
        f"""SELECT client_name, t, list_concat([new], t[2:]) AS h, new, 0 AS variant_ix FROM (SELECT client_name, t, {get(v.COUNTERPART, fold('t[1]'))} AS new FROM ct) a
        WHERE new IS NOT NULL AND len(list_filter(t[2:], lambda x: {fold('x')} = {fold('new')})) = 0""",
        join("t[2:]"), f"'client carries the ' || {get(v.GENDER, fold('t[1]'))} || ' form ''' || t[1] || ''', hit carries its ' || {get(v.GENDER, fold('new'))} || ' counterpart ''' || new || ''''",
        f"CASE WHEN len(t) > 2 THEN '''' || {join('t[2:-2]')} || ''' matches exactly' ELSE {AB} END", SAME9, worded("BOUNDARY_GENDER_VARIANT", "DISP_GIVEN_NAME_GENDER_VARIANT"), "PRINCIPLE_GENDER_MISMATCH",
    ),
    "mut_typo": walked(
        "DISP_MINOR_TYPO",
        f"""SELECT client_name, t, list_concat(list_concat(t[1:tok - 1], [e.new]), t[tok + 1:]) AS h, tok, e.what AS what, ((tok - 1) * 1000 + ix) * 100 + en AS variant_ix FROM (
        SELECT client_name, t, tok, ix, unnest(edits) AS e, unnest(range(len(edits))) AS en FROM (
          SELECT client_name, t, tok, ix, CASE WHEN length(old) <= 3 THEN [{{'new': old || 'n', 'what': 'single typographical character append'}}] ELSE list_concat(list_concat(
            CASE WHEN c <> d THEN [{{'new': old[:ix] || d || c || old[ix + 3:], 'what': 'adjacent character transposition (''' || c || d || ''' -> ''' || d || c || ''')'}}] ELSE [] END,
            list_transform(string_split(coalesce({get(v.NEIGHBOURS, 'lower(c)')}, 'aeiou'), ''), lambda y: {{'new': old[:ix] || CASE WHEN upper(c) = c AND lower(c) <> c THEN upper(y) ELSE y END || old[ix + 2:], 'what': 'single typographical substitution (''' || c || ''' -> ''' || CASE WHEN upper(c) = c AND lower(c) <> c THEN upper(y) ELSE y END || ''')'}})),
            [{{'new': old[:ix] || old[ix + 2:], 'what': 'single typographical omission of character ''' || c || ''''}}]) END AS edits
          FROM (SELECT *, substr(old, ix + 1, 1) AS c, substr(old, ix + 2, 1) AS d FROM (
            SELECT client_name, t, tok, old, unnest(CASE WHEN length(old) > 3 THEN range(1, length(old) - 1) ELSE [0] END) AS ix FROM (
              SELECT client_name, t, unnest(t) AS old, unnest(range(1, len(t) + 1)) AS tok FROM ct) x1) x2) x3) x4) x5""",
        join("list_concat(t[1:tok - 1], t[tok + 1:])"), f"'The affected token shows ' || what || '; ' || {worded('BOUNDARY_MINOR_TYPO', 'DISP_MINOR_TYPO')}",
    ),
}


def gender_pair(c: str, h: str) -> str:
    d = f"list_filter(range(1, len({c}) + 1), lambda i: lower({c}[i]) <> lower({h}[i]))"
    x, y = fold(f"{c}[({d})[1]]"), fold(f"{h}[({d})[1]]")
    return f"(len({c}) = len({h}) AND len({d}) = 1 AND (coalesce({fold(get(v.COUNTERPART, x))} = {y}, false) OR coalesce({fold(get(v.COUNTERPART, y))} = {x}, false)))"


def _problem() -> str:
    same, only = "lower(client_name) = lower(hit_name)", "(len(c) = len(h) AND len(d) = 1 AND d[1] = {})"
    one = "(len(c) = len(h) AND len(d) = 1)"
    rom = f"(list_contains(list_transform(coalesce({get(v.ROMANISED, 'lower(c[d[1]])')}, []), lambda x: lower(x)), lower(h[d[1]])) OR list_contains(list_transform(coalesce({get(v.ROMANISED, 'lower(h[d[1]])')}, []), lambda x: lower(x)), lower(c[d[1]])))"
    marks = f"(list_contains({arr([f'{a}|{b}' for x, y in v.ACCENTED for a, b in ((x, y), (y, x))])}, c[d[1]] || '|' || h[d[1]]) OR {strip('c[d[1]]')} = {strip('h[d[1]]')})"
    curated = f"list_contains(list_transform(coalesce({get(v.PHONETIC, 'lower(c[-1])')}, []), lambda x: lower(x)), lower(h[-1]))"
    rules = {
        "DISP_EXACT_NAME_MATCH": [(f"NOT ({same})", "not an identical name pair")],
        "DISP_GIVEN_NAME_GENDER_VARIANT": [(f"NOT {gender_pair('c', 'h')}", "tokens do not differ by a single curated gendered given name")],
        "DISP_MINOR_TYPO": [(same, "pair is identical"), (gender_pair("c", "h"), "pair is a curated cross-gender variant (belongs to DISP_GIVEN_NAME_GENDER_VARIANT)"), (f"levenshtein({fold('client_name')}, {fold('hit_name')}) > 2", "edit distance exceeds the documented <= 2 typo contract")],
        "DISP_TOKEN_ORDER_SWAP": [("list_sort(list_transform(c, lambda x: lower(x))) <> list_sort(list_transform(h, lambda x: lower(x)))", "token multisets differ (not a pure reordering)"), (same, "no reordering occurred")],
        "DISP_MIDDLE_NAME_ABBREVIATED": [(f"NOT {only.format(2)}", "more than the middle token changed"), ("length(c[2]) <= 2 OR h[2] <> upper(c[2][1]) || '.'", "middle token was not shortened to its initial")],
        "DISP_MIDDLE_INITIAL_EXPANDED": [(f"NOT {only.format(2)}", "more than the middle token changed"), ("length(c[2]) > 2 OR length(h[2]) <= 2", "middle initial was not expanded"), (f"NOT list_contains({arr(v.MIDDLE_NAMES)}, h[2])", "expanded middle token is not from the curated middle-name pool")],
        "DISP_MIDDLE_NAME_OMITTED": [("NOT ((len(h) = len(c) - 1 AND lower(c[1]) = lower(h[1]) AND c[3:] = h[2:]) OR (len(h) = len(c) + 1 AND regexp_full_match(h[2], '[A-Za-z]\\.') AND lower(c[1]) = lower(h[1]) AND c[2:] = h[3:]))", "neither a middle-name omission nor an added middle initial")],
        "DISP_TRANSLITERATION_VARIANT": [(f"NOT {one}", "more than one token differs"), (f"NOT {rom}", "differing token is not a known cross-standard transliteration variant")],
        "DISP_DIACRITIC_STRIPPED": [(f"NOT {one}", "more than one token differs"), (f"NOT {marks}", "differing token is not a diacritic-only variant")],
        "DISP_COMPOUND_NAME_RESTRUCTURED": [(same, "pair is identical"), ("lower(replace(client_name, '-', ' ')) <> lower(replace(hit_name, '-', ' '))", "a hyphen split/merge does not account for the difference")],
        "DISP_SURNAME_CONFLICT": [(f"NOT {only.format('len(c)')}", "only the surname may differ for this code"), (f"NOT list_contains({arr(v.SURNAMES)}, h[-1])", "replacement surname is not from the curated distinct-surname pool")],
        "DISP_MIDDLE_NAME_CONFLICT": [(f"len(c) = len(h) AND NOT {only.format(2)}", "only the middle token may differ for this code"), (f"len(c) <> len(h) AND NOT (len(h) = len(c) + 1 AND lower(c[1]) = lower(h[1]) AND lower(c[-1]) = lower(h[-1]) AND list_contains({arr(v.MIDDLE_NAMES)}, h[2]))", "neither a conflicting middle token nor an introduced middle name")],
        "DISP_PHONETIC_SURNAME_DIVERGENCE": [(same, "pair is identical"), (f"NOT {curated} AND {strip('c[-1]')} = {strip('h[-1]')}", "surnames differ only by diacritics (belongs to DISP_DIACRITIC_STRIPPED)"), (f"NOT {curated} AND levenshtein({fold('c[-1]')}, {fold('h[-1]')}) <= 1", "surnames differ by a single character (belongs to DISP_MINOR_TYPO)"), (f"NOT {curated} AND NOT regexp_full_match(h[-1], '[\\p{{L}}''\\- ]*')", "replacement surname is not a well-formed name token")],
    }
    whens = " ".join(f"WHEN disposition_code = '{code}' AND coalesce({test}, true) THEN {lit(text)}" for code, tests in rules.items() for test, text in tests)
    return f"CASE WHEN disposition_code = 'X' THEN 'unknown disposition code ''X''' {whens} END"


AUDIT = f"{PAIRS}, au AS (SELECT *, {_problem()} AS problem FROM pd)"


def apportioned(weights: str, total: str, by: str = "") -> str:
    """weights: relation with code, weight and the columns of `by` and `total`."""
    part = f"PARTITION BY {by}" if by else ""
    cols = f"{by}, " if by else ""
    return f"""(SELECT {cols}code, CAST(fl + (lft // n) + CASE WHEN rn <= lft % n THEN 1 ELSE 0 END AS BIGINT) AS quota FROM (
      SELECT *, row_number() OVER ({part} ORDER BY ex - fl DESC, code) AS rn, {total} - sum(fl) OVER ({part}) AS lft, count(*) OVER ({part}) AS n FROM (
        SELECT *, CAST(floor(ex) AS BIGINT) AS fl FROM (SELECT *, CAST({total} AS DOUBLE) * (weight / sum(weight) OVER ({part})) AS ex FROM {weights} WHERE weight > 0) q1) q2) q3)"""


TP_FLOOR = [(c, 2.0 if c == "DISP_MINOR_TYPO" else 1.0) for c in v.TRUE_POSITIVE if c != "DISP_EXACT_NAME_MATCH"]
FP_FLOOR = [(c, 1.0) for c in v.FALSE_POSITIVE if c != "DISP_SURNAME_CONFLICT"]
FLOORS = f"""fl AS (SELECT code, 'TP' AS family, quota FROM {apportioned('(SELECT code, CAST(weight AS DOUBLE) AS weight FROM ' + values(TP_FLOOR, 'z(code, weight)') + ') y', '60')} a
  UNION ALL SELECT 'DISP_EXACT_NAME_MATCH', 'TP', 30
  UNION ALL SELECT code, 'FP', quota FROM {apportioned('(SELECT code, CAST(weight AS DOUBLE) AS weight FROM ' + values(FP_FLOOR, 'z(code, weight)') + ') y', '60')} b)"""
EVEN = values([(c, f) for f, xs in (("TP", v.TRUE_POSITIVE), ("FP", v.FALSE_POSITIVE)) for c in xs], "z(code, family)")


def _caps() -> str:
    two = "list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])"
    accents = sorted({x for pair in v.ACCENTED for x in pair})
    new = fold(get(v.COUNTERPART, fold("t[1]")))
    tests = {
        "DISP_MIDDLE_NAME_ABBREVIATED": "len(t) >= 3 AND length(t[2]) > 2",
        "DISP_MIDDLE_INITIAL_EXPANDED": "len(t) >= 3 AND length(t[2]) <= 2",
        "DISP_TRANSLITERATION_VARIANT": f"list_has_any(list_transform(t, lambda x: lower(x)), {arr(v.ROMANISED)})",
        "DISP_DIACRITIC_STRIPPED": f"list_has_any(t, {arr(accents)}) OR len(list_filter(t, lambda x: {strip('x')} <> '' AND {strip('x')} <> x)) > 0",
        "DISP_COMPOUND_NAME_RESTRUCTURED": f"list_has_any(t, {arr(sorted({h for h, _ in v.COMPOUND}))}) OR list_has_any({two}, {arr(sorted({s for _, s in v.COMPOUND if len(s.split()) == 2}))})",
        "DISP_PHONETIC_SURNAME_DIVERGENCE": f"list_contains({arr(v.PHONETIC)}, lower(t[-1]))",
        "DISP_GIVEN_NAME_GENDER_VARIANT": f"{new} IS NOT NULL AND len(list_filter(t[2:], lambda x: {fold('x')} = {new})) = 0",
    }
    return " UNION ALL ".join(f"SELECT '{c}' AS code, client_name FROM ct WHERE len(t) >= 2 AND ({tests.get(c, 'true')})" for c in v.CODES)


CAPS = f"{POOL}, caps AS ({_caps()})"
ANSWERS = f"""{PAIRS}, an AS (SELECT k, client_name, hit_name, '{{"' || ['thinking', 'reasoning', 'analysis'][(k // 2) % 3 + 1] || '":"Names compared' || CASE WHEN k % 4 = 0 THEN '. Therefore: something' ELSE '' END AS x,
  ['Escalate', 'reject', 'unsure'][k % 3 + 1] AS said, ['DISP_MINOR_TYPO', 'minor typo', 'surname-conflict', 'middle-name', 'typo', 'DISP_EXACT_NAME_MATCH'][k % 6 + 1] AS raw_code,
  CASE WHEN k % 2 = 0 THEN '{v.ESCALATE}' ELSE '{v.DISQUALIFY}' END AS target, CASE WHEN k % 2 = 0 THEN 'DISP_MINOR_TYPO' ELSE 'DISP_SURNAME_CONFLICT' END AS fb FROM p),
a1 AS (SELECT *, k % 10 = 2 AS bad, CASE WHEN k % 3 = 0 THEN '{v.ESCALATE}' WHEN k % 3 = 1 THEN '{v.DISQUALIFY}' ELSE target END AS dec,
  'DISP_' || upper(regexp_replace(CASE WHEN raw_code LIKE 'DISP_%' THEN raw_code[6:] ELSE raw_code END, '[\\s\\-]+', '_', 'g')) AS nc FROM an),
a2 AS (SELECT *, CASE WHEN list_contains({arr(v.CODES)}, nc) THEN nc ELSE coalesce(list_filter({arr(v.CODES)}, lambda q: contains(nc, q) OR contains(q, nc))[1], fb) END AS c0 FROM a1),
a3 AS (SELECT *, c0 = 'DISP_EXACT_NAME_MATCH' AND lower(client_name) <> lower(hit_name) AS odd FROM a2),
a4 AS (SELECT *, CASE WHEN odd THEN fb ELSE c0 END AS c1 FROM a3),
a5 AS (SELECT *, {get(v.DECISIONS, 'c1')} AS fam, k % 5 = 0 AS enf FROM a4),
a6 AS (SELECT *, CASE WHEN enf THEN fb ELSE c1 END AS c2, CASE WHEN enf THEN target ELSE fam END AS d2,
  CASE WHEN enf AND fb <> c1 THEN 1 ELSE 0 END AS code_fixed, CASE WHEN fam <> dec THEN 1 ELSE 0 END + CASE WHEN enf AND target <> fam THEN 1 ELSE 0 END AS decision_fixed FROM a5),
wd AS (SELECT *, regexp_extract_all(hit_name, '[\\p{{L}}\\p{{N}}_]+') AS hw, regexp_extract_all(lower(client_name), '[\\p{{L}}\\p{{N}}_]+') AS cw FROM a6),
ov AS (SELECT *, list_filter(hw, lambda w: list_contains(cw, lower(w))) AS found FROM wd),
o2 AS (SELECT *, list_filter(found, lambda w, i: list_position(list_transform(found, lambda y: lower(y)), lower(w)) = i) AS once FROM ov),
ans AS (SELECT k, client_name, hit_name, bad, target, fb, CASE WHEN k % 2 = 0 THEN 'Ali' WHEN len(once) > 0 THEN {join('once')} ELSE hit_name END AS mt, c2, d2,
  'Names compared. Therefore: ' || c2 || ' -> ' || d2 || '.' AS th, CASE WHEN bad THEN 0 WHEN odd THEN 1 ELSE 0 END AS plausibility, CASE WHEN bad THEN 0 ELSE code_fixed END AS code_fixed, CASE WHEN bad THEN 0 ELSE decision_fixed END AS decision_fixed, enf FROM o2)"""
LABELS = mapping(v.LABELS)
THREE = " UNION ALL ".join(f"SELECT code, client_name, variant_ix, hit_name, matching_text, thinking FROM ({MUTATIONS[m]}) {m}" for m in ("mut_exact", "mut_order_swap", "mut_gender"))
PROMPT_TAIL = "\nAnswer in JSON with exactly the fields matching_text, disposition_code, thinking, decision."

ORACLE_SQL: dict[str, str] = {
    "name_clean": f"""WITH {RAW}, s AS (SELECT k, trim(trim(trim(raw), '"'), '''') AS n FROM raws), c AS (SELECT k, n, {join(cased(toks(untitled(inverted('n')))))} AS full_name FROM s)
        SELECT k, CASE WHEN n = '' OR {entity('n')} OR len(string_split(full_name, ' ')) < 2 THEN NULL ELSE full_name END AS name FROM c""",
    "entity_filter": f"WITH {RAW} SELECT k, {entity('raw')} AS entity FROM raws",
    "surname_first": f"WITH {RAW} SELECT k, {inverted('raw')} AS name FROM raws",
    "title_strip": f"WITH {RAW} SELECT k, {untitled('raw')} AS name FROM raws",
    "case_normalise": f"SELECT p_partkey, {join(cased(toks('CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END')))} AS name FROM part",
    "ci_dedupe": f"WITH {POOL}, q AS (SELECT CASE WHEN k % 2 = 0 THEN upper(client_name) ELSE client_name END AS name, k AS ord FROM pool) SELECT name, ord FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY ord) AS rn FROM q) z WHERE rn = 1",
    "pool_union": f"WITH {POOL}, q AS (SELECT client_name AS name, 0 AS rank, k AS ord FROM pool UNION ALL SELECT name, 1, ord FROM {values([(n, k) for k, n in enumerate(n for xs in v.WORLD_NAMES.values() for n in xs)], 'w(name, ord)')}) SELECT name, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY rank, ord) AS rn FROM q) z WHERE rn = 1",
    "generated_name_accept": f"WITH {POOL}, q AS (SELECT k, CASE k % 3 WHEN 0 THEN client_name || ' 2' WHEN 1 THEN client_name || ' Th.S.' ELSE client_name END AS n FROM pool) SELECT k, len(list_filter({toks('n')}, lambda w: regexp_matches(w, '[0-9]') OR (contains(w, '.') AND NOT regexp_full_match(w, '[A-Za-z]\\.')))) = 0 AS ok FROM q",
    "label_lookup": f"WITH {PAIRS} SELECT k, coalesce({LABELS}[disposition_code], 'Unknown disposition code') AS label, {get(v.DECISIONS, 'disposition_code')} AS family_decision FROM p",
    "phonetic_lookup": f"WITH {POOL} SELECT client_name, t[-1] AS token, f.form FROM ct JOIN {swapped(v.PHONETIC, '')} ON f.key = lower(t[-1])",
    "translit_lookup": f"WITH {POOL} SELECT client_name, CAST(pos AS BIGINT) AS pos, tok AS token, f.form FROM (SELECT client_name, unnest(t) AS tok, unnest(range(len(t))) AS pos FROM ct) a JOIN {swapped(v.ROMANISED, '')} ON f.key = lower(tok)",
    "gender_lookup": f"WITH {POOL} SELECT client_name, {get(v.COUNTERPART, fold('t[1]'))} AS counterpart, {get(v.GENDER, fold('t[1]'))} AS gender FROM ct",
    "ascii_fold": f"WITH {POOL} SELECT client_name, {fold('client_name')} AS folded, {strip('client_name')} AS stripped FROM clients",
    "levenshtein_filter": f"WITH {PAIRS} SELECT k, levenshtein({fold('client_name')}, {fold('hit_name')}) AS distance, levenshtein({fold('client_name')}, {fold('hit_name')}) <= 2 AS near FROM p",
    "token_diff": f"WITH {PAIRS} SELECT k, array_to_string(list_transform(d, lambda i: CAST(i - 1 AS VARCHAR)), ',') AS at, CAST(len(d) AS BIGINT) AS n FROM pd",
    "overlap_tokens": f"WITH {PAIRS}, w AS (SELECT k, {strip('hit_name')} AS hn, regexp_extract_all({strip('hit_name')}, '\\w+') AS hw, regexp_extract_all({fold('client_name')}, '\\w+') AS cw FROM p), f AS (SELECT *, list_filter(hw, lambda x: list_contains(cw, lower(x))) AS fd FROM w), o AS (SELECT *, list_filter(fd, lambda x, i: list_position(list_transform(fd, lambda y: lower(y)), lower(x)) = i) AS once FROM f) SELECT k, CASE WHEN len(once) > 0 THEN {join('once')} ELSE hn END AS overlap FROM o",
    "walk_note": f"WITH {PAIRS} SELECT k, {note('c[1]', 'h[1]')} AS given, {note('c[-1]', 'h[-1]')} AS surname, CASE WHEN len(c) = len(h) THEN ({mid_note('c', 'h')}) END AS middle FROM p",
    "compose_trace": f"WITH {PAIRS} SELECT k, 'Client ''' || client_name || ''' vs hit ''' || hit_name || '''. Given: g. Middle: m. Surname: s. B. P. Therefore: ' || disposition_code || ' -> ' || decision || '.' AS thinking FROM p",
    "closure_check": f"WITH {PAIRS} SELECT k, k % 2 = 0 AS closes FROM p",
    **MUTATIONS,
    "gender_pairs": f"WITH {PAIRS}, q AS (SELECT k, c, {toks('CASE WHEN k % 2 = 0 THEN regexp_replace(client_name, ' + lit('^Daniel ') + ', ' + lit('Daniela ') + ') ELSE hit_name END')} AS hh FROM p) SELECT k, {gender_pair('c', 'hh')} AS gender_pair FROM q",
    "capability_matrix": f"WITH {CAPS} SELECT code, client_name FROM caps",
    "capacity_report": f"""WITH {CAPS}, plan AS (SELECT code, quota FROM {apportioned("(SELECT code, family, CAST(1 AS DOUBLE) AS weight, CASE family WHEN 'TP' THEN 9000 ELSE 4000 END AS total FROM " + EVEN + ") y", 'total', 'family')} x)
        SELECT code, quota, coalesce(n, 0) AS pool_size, CAST(coalesce(n, 0) * {get(v.VARIANTS, 'code')} AS BIGINT) AS capacity, quota > 0 AND coalesce(n, 0) * {get(v.VARIANTS, 'code')} < quota AS short
        FROM plan LEFT JOIN (SELECT code AS c, count(*) AS n FROM caps GROUP BY code) s ON s.c = code""",
    "apportion_even": f"SELECT code, quota FROM {apportioned('(SELECT z.code, CAST(1 AS DOUBLE) AS weight, o.n FROM ' + values([(c, 1) for c in v.TRUE_POSITIVE], 'z(code, one)') + ', (SELECT count(*) AS n FROM orders) o) y', 'n')} x",
    "apportion_weighted": f"SELECT grp, code, quota FROM {apportioned('(SELECT o.grp, z.code, CAST(z.w AS DOUBLE) AS weight, o.n FROM ' + values([(c, 1 + k % 4) for k, c in enumerate(v.CODES)], 'z(code, w)') + ', (SELECT c_nationkey % 5 AS grp, count(*) AS n FROM customer GROUP BY 1) o) y', 'n', 'grp')} x",
    "quota_floors": f"WITH {FLOORS} SELECT code, family, quota FROM fl",
    "pipeline_split": f"WITH {FLOORS}, s AS (SELECT *, CASE WHEN code = 'DISP_EXACT_NAME_MATCH' THEN quota ELSE CAST(floor(CAST(0.29 AS DOUBLE) * quota) AS BIGINT) END AS a FROM fl) SELECT code, quota, a, quota - a AS b FROM s",
    "slot_expand": f"WITH {FLOORS} SELECT code, unnest(range(1, quota + 1)) AS slot FROM fl WHERE quota > 0",
    "family_totals": f"WITH {FLOORS}, s AS (SELECT *, CASE WHEN code = 'DISP_EXACT_NAME_MATCH' THEN quota ELSE CAST(floor(CAST(0.3 AS DOUBLE) * quota) AS BIGINT) END AS a FROM fl) SELECT family, CAST(sum(quota) AS BIGINT) AS quota, CAST(sum(a) AS BIGINT) AS a, CAST(sum(quota - a) AS BIGINT) AS b FROM s GROUP BY family",
    "sample_without_replacement": f"WITH {POOL} SELECT client_name FROM clients ORDER BY md5(client_name || 'exact42'), client_name LIMIT 40",
    "gender_interleave": f"WITH {POOL}, g AS (SELECT client_name, {get(v.GENDER, fold('t[1]'))} AS gender FROM ct), r AS (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY md5(client_name || '42'), client_name) AS turn FROM g WHERE gender IS NOT NULL) SELECT client_name, gender, turn FROM r WHERE turn <= 15",
    "unique_pairs": f"""WITH cand AS ({THREE}), ok AS (SELECT * FROM cand WHERE code = 'DISP_EXACT_NAME_MATCH' OR lower(client_name) <> lower(hit_name)),
        sup AS (SELECT code, count(*) / CAST(max(CASE code WHEN 'DISP_GIVEN_NAME_GENDER_VARIANT' THEN 15 ELSE 20 END) AS DOUBLE) AS ratio FROM ok GROUP BY code),
        rk AS (SELECT ok.*, md5(ok.code || '|' || client_name || '|' || hit_name || '|42') AS rank, ratio FROM ok JOIN sup ON ok.code = sup.code),
        one AS (SELECT *, row_number() OVER (PARTITION BY lower(client_name), lower(hit_name) ORDER BY ratio, code, rank) AS rn FROM rk),
        f AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY rank) AS slot FROM one WHERE rn = 1)
        SELECT client_name, hit_name, matching_text, code AS disposition_code, {LABELS}[code] AS disposition_label, thinking, {get(v.DECISIONS, 'code')} AS decision, 'rule_based' AS created_by
        FROM f WHERE slot <= CASE code WHEN 'DISP_GIVEN_NAME_GENDER_VARIANT' THEN 15 ELSE 20 END""",
    "audit_pairs": f"WITH {AUDIT} SELECT k, disposition_code, problem FROM au",
    "audit_summary": f"WITH {AUDIT} SELECT disposition_code, count(*) AS n FROM au WHERE problem IS NOT NULL GROUP BY disposition_code",
    "balance_check": f"WITH {PAIRS}, {FLOORS}, g AS (SELECT disposition_code AS dc, count(*) AS n FROM p GROUP BY 1) SELECT coalesce(dc, code) AS disposition_code, CAST(coalesce(quota, 0) AS BIGINT) AS planned, coalesce(n, 0) AS emitted, CAST(coalesce(n, 0) - coalesce(quota, 0) AS BIGINT) AS delta, coalesce(coalesce(n, 0) = quota, false) AS ok FROM fl FULL OUTER JOIN g ON dc = code",
    "category_integrity": f"""WITH {PAIRS} SELECT count(*) FILTER (client_name = hit_name) AS identical, count(*) FILTER (client_name = hit_name AND disposition_code = 'DISP_EXACT_NAME_MATCH' AND decision = '{v.ESCALATE}') AS identical_labelled,
        count(*) FILTER (disposition_code = 'DISP_GIVEN_NAME_GENDER_VARIANT') AS gender, count(*) FILTER (disposition_code = 'DISP_GIVEN_NAME_GENDER_VARIANT' AND {gender_pair('c', 'h')}) AS gender_labelled,
        count(*) FILTER (disposition_code = 'DISP_MINOR_TYPO' AND {gender_pair('c', 'h')}) AS typos_that_are_gender_pairs FROM p""",
    "distribution": f"WITH {PAIRS}, n AS (SELECT disposition_code, count(*) AS n FROM p GROUP BY 1) SELECT disposition_code, coalesce({LABELS}[disposition_code], 'Unknown disposition code') AS disposition_label, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 4) AS percent FROM n",
    "unique_check": f"WITH {PAIRS} SELECT count(*) AS n, count(DISTINCT client_name || chr(31) || hit_name) AS distinct_pairs FROM p",
    "merge_dedupe": f"WITH {PAIRS}, q AS (SELECT client_name, hit_name, disposition_code, 0 AS f FROM p WHERE disposition_code LIKE 'DISP_M%' UNION ALL SELECT client_name, hit_name, disposition_code, 1 FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY client_name, hit_name ORDER BY f, disposition_code) AS rn FROM q) SELECT disposition_code, count(*) AS n FROM r WHERE rn = 1 GROUP BY 1",
    "llm_normalise": f"WITH {ANSWERS} SELECT k, CASE WHEN NOT bad THEN mt END AS matching_text, CASE WHEN NOT bad THEN c2 END AS disposition_code, CASE WHEN NOT bad THEN th END AS thinking, CASE WHEN NOT bad THEN d2 END AS decision, CAST(plausibility AS BIGINT) AS plausibility, CAST(code_fixed AS BIGINT) AS code_fixed, CAST(decision_fixed AS BIGINT) AS decision_fixed, CASE WHEN bad THEN 'no JSON' END AS error FROM ans",
    "llm_fallback": f"""WITH {ANSWERS}, z AS (SELECT *, NOT bad AND d2 = target AND decision_fixed = 0 AND (NOT enf OR code_fixed = 0) AS ok FROM ans)
        SELECT client_name, hit_name, CASE WHEN ok THEN mt ELSE 'rule' END AS matching_text, CASE WHEN ok THEN c2 ELSE fb END AS disposition_code, {LABELS}[CASE WHEN ok THEN c2 ELSE fb END] AS disposition_label,
        CASE WHEN ok THEN th ELSE 'rule text' END AS thinking, CASE WHEN ok THEN d2 ELSE target END AS decision, CASE WHEN ok THEN 'ollama' ELSE 'rule_based' END AS created_by FROM z""",
    "llm_tallies": f"WITH {ANSWERS} SELECT CAST(sum(plausibility) AS BIGINT) AS plausibility, CAST(sum(decision_fixed) AS BIGINT) AS decision, CAST(sum(code_fixed) AS BIGINT) AS disposition_code, count(*) FILTER (bad) AS errors FROM ans",
    "llm_prompt": f"""WITH {PAIRS} SELECT k, 'Client Name: "' || client_name || '"' || chr(10) || 'Candidate Hit Name: "' || hit_name || '"' || chr(10) ||
        CASE WHEN {gender_pair('c', 'h')} THEN 'The names differ by one token, and it is the gendered counterpart of the other; judge whether one person can bear both, and conclude with ''disqualify''.'
          WHEN decision = '{v.ESCALATE}' THEN 'The hit is likely the same person with a difference in recording; conclude with ''escalate to analyst''.' ELSE 'The hit is another person despite some overlap; conclude with ''disqualify''.' END ||
        CASE WHEN disposition_code <> 'X' THEN chr(10) || 'The difference to explain is ' || disposition_code || ' (' || {LABELS}[disposition_code] || '); disposition_code must be it.' ELSE '' END || {lit(PROMPT_TAIL)} AS prompt FROM p""",
    "generation_estimate": f"WITH {POOL} SELECT k, round(k * 100 * (CAST(k % 101 AS DOUBLE) / 100.0) / 20000.0 + k * 100 * (CAST(100 - k % 101 AS DOUBLE) / 100.0) / greatest(5.0, least(15.0, (k % 40) * CAST(0.8 AS DOUBLE))), 6) AS seconds FROM pool",
    "distinct_parts": f"WITH {POOL}, q AS (SELECT DISTINCT t[1] AS part, 0 AS w FROM ct UNION ALL SELECT DISTINCT t[-1], 1 FROM ct) SELECT part, count(*) AS lists FROM q GROUP BY part",
    "first_match": f"WITH {POOL} SELECT t[-1] AS surname, min(k) AS k FROM (SELECT k, {toks('client_name')} AS t FROM pool) a GROUP BY 1",
}
ORACLE_SQL["csv_roundtrip"] = ORACLE_SQL["unique_pairs"]


def cleaned(x: str) -> str:
    """The normalised name of a raw one, or null."""
    bare = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    n = f"trim(trim({bare}, '\"'), '''')"
    return f"(SELECT CASE WHEN n = '' OR {entity('n')} OR len(string_split(full_name, ' ')) < 2 THEN NULL ELSE full_name END FROM (SELECT n, {join(cased(toks(untitled(inverted('n')))))} AS full_name FROM (SELECT {n} AS n) c1) c2)"


def _locales() -> str:
    rows = []
    for k, locale in enumerate(v.LOCALES):
        names = v.WORLD_NAMES[v.REGION_OF[locale[:2]]]
        rows.append(f"({k}, {lit(locale)}, {arr(sorted({n.split()[0] for n in names}))}, {arr(sorted({n.split()[-1] for n in names}))})")
    return "(VALUES " + ", ".join(rows) + ") AS l(place, locale, gs, fs)"


def one_of(xs: str, key: str, salt: str) -> str:
    return f"{xs}[{pick(key, salt, 1).removesuffix(' % 1)')} % len({xs})) + 1]"


ORACLE_SQL["generated_names"] = f"""WITH r AS (SELECT place, ix, gs, fs, locale || '|' || ix AS key FROM {_locales()}, range(40) t(ix)),
n AS (SELECT place * 40 + ix AS ord, {one_of('gs', 'key', 'given')} AS g, {one_of('gs', 'key', 'second')} AS g2, {one_of('fs', 'key', 'family')} AS f, {pick('key', 'share', 1000)} < 350 AS share, ix FROM r),
m AS (SELECT ord, CASE WHEN ix > 0 AND ix % 5 = 0 THEN 'Dr. ' || g || ' ' || f WHEN share THEN g || ' ' || g2 || ' ' || f ELSE g || ' ' || f END AS raw FROM n),
c AS (SELECT {cleaned('raw')} AS name, CAST(ord AS BIGINT) AS ord FROM m)
SELECT name, ord FROM c WHERE name IS NOT NULL AND len(list_filter({toks('name')}, lambda w: regexp_matches(w, '[0-9]') OR (contains(w, '.') AND NOT regexp_full_match(w, '[A-Za-z]\\.')))) = 0"""

_ODD = ["NA", None, "null", 'Ana "Bo" Li', "Ana, Li\nZoe", "#N/A", "ACME, LLC"]
ORACLE_SQL["csv_names"] = f"""WITH {RAW}, o AS (SELECT CASE WHEN k % 11 = 0 THEN [{', '.join('NULL' if x is None or x in ('NA', 'null', '#N/A') else lit(x) for x in _ODD)}][(k // 11) % 7 + 1] ELSE raw END AS raw FROM raws),
c AS (SELECT {cleaned('raw')} AS name FROM o WHERE raw IS NOT NULL) SELECT lower(name) AS folded, count(*) AS n FROM c WHERE name IS NOT NULL GROUP BY 1"""
ORACLE_SQL["appended_alerts"] = f"SELECT client_name, hit_name, {LABELS}['DISP_TOKEN_ORDER_SWAP'] AS disposition_label, thinking FROM ({MUTATIONS['mut_order_swap']}) m"
ORACLE_SQL["option_counts"] = """WITH o(k, total, tp, fp, tpp, llm, ex, ge, exp, gep, bad) AS (VALUES
  (0, 100, NULL, NULL, 50.0, 70.0, NULL, NULL, 2.0, 2.0, false), (1, 101, NULL, NULL, 50.0, 70.0, NULL, NULL, 2.0, 2.0, false), (2, 33, NULL, NULL, 25.0, 70.0, NULL, NULL, 2.0, 2.0, false),
  (3, 100, 40, NULL, 50.0, 70.0, NULL, NULL, 2.0, 2.0, false), (4, 50, NULL, 7, 50.0, 70.0, NULL, NULL, 2.0, 2.0, false), (5, NULL, 12, 30, 50.0, 70.0, 5, 0, 2.0, 2.0, false),
  (6, 250, NULL, NULL, 50.0, 70.0, NULL, NULL, 1.0, 3.0, false), (7, 5, NULL, NULL, 50.0, 10.0, NULL, NULL, 2.0, 2.0, false),
  (8, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true), (9, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true), (10, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true)),
a AS (SELECT *, coalesce(tp, total - fp, CAST(round_even(tpp / 100.0 * total, 0) AS BIGINT)) AS t FROM o), b AS (SELECT *, coalesce(fp, total - t) AS f FROM a)
SELECT CAST(k AS BIGINT) AS k, CASE WHEN NOT bad THEN CAST(t AS BIGINT) END AS num_tp, CASE WHEN NOT bad THEN CAST(f AS BIGINT) END AS num_fp, CASE WHEN NOT bad THEN round(CAST(t AS DOUBLE) / (t + f) * 100.0, 6) END AS tp_pct,
  CASE WHEN NOT bad THEN CAST(llm AS DOUBLE) END AS llm_pct, CASE WHEN NOT bad THEN CAST(coalesce(ex, round_even(exp / 100.0 * (t + f), 0)) AS BIGINT) END AS exact,
  CASE WHEN NOT bad THEN CAST(coalesce(ge, round_even(gep / 100.0 * (t + f), 0)) AS BIGINT) END AS gender, bad AS error FROM b"""
_TP_WEIGHTED = values([(c, 3.0 if c == "DISP_MINOR_TYPO" else 1.0) for c in v.TRUE_POSITIVE if c != "DISP_EXACT_NAME_MATCH"], "z(code, weight)")
_FP_WEIGHTED = values([(c, 0.5 if c == "DISP_SURNAME_CONFLICT" else 1.0) for c in v.FALSE_POSITIVE], "z(code, weight)")
ORACLE_SQL["option_plan"] = f"""WITH n AS (SELECT count(*) AS n FROM customer), t AS (SELECT CAST(round_even(n / 2.0, 0) AS BIGINT) AS tp, n - CAST(round_even(n / 2.0, 0) AS BIGINT) AS fp FROM n)
SELECT code, 'TP' AS family, quota FROM {apportioned('(SELECT code, CAST(weight AS DOUBLE) AS weight, tp FROM ' + _TP_WEIGHTED + ', t) y', 'tp')} a
UNION ALL SELECT code, 'FP', quota FROM {apportioned('(SELECT code, CAST(weight AS DOUBLE) AS weight, fp FROM ' + _FP_WEIGHTED + ', t) y', 'fp')} b"""
_CURATED = [x for x, _ in v.ACCENTED]
ORACLE_SQL["synthesised_names"] = f"""WITH {POOL}, s AS (SELECT x, row_number() OVER (ORDER BY md5(x || '42')) - 1 AS ix FROM (SELECT DISTINCT t[-1] AS x FROM ct) q),
d AS (SELECT id, 'DISP_DIACRITIC_STRIPPED|' || id AS key FROM range(150) r(id)),
m AS (SELECT id, {arr(_CURATED)}[{pick('key', 'token', len(_CURATED))} + 1] || ' ' || s.x AS client_name FROM d JOIN s ON s.ix = {pick('key', 'surname', 1).removesuffix(' % 1)')} % (SELECT count(*) FROM s))),
g AS (SELECT lower(client_name) AS k, arg_min(client_name, id) AS client_name, min(id) AS id FROM m GROUP BY 1)
SELECT client_name FROM g ORDER BY id LIMIT 50"""
ORACLE_SQL["llm_tallies"] = f"""WITH {ANSWERS}, w AS (SELECT *, NOT bad AND d2 <> target AS other FROM ans)
SELECT CAST(sum(plausibility) AS BIGINT) AS plausibility, CAST(sum(decision_fixed) AS BIGINT) AS decision, CAST(sum(code_fixed) AS BIGINT) AS disposition_code, count(*) FILTER (other) AS decision_mismatch,
  count(*) FILTER (NOT bad AND NOT other AND decision_fixed = 0 AND k % 5 = 0 AND code_fixed > 0) AS code_mismatch_discards, count(*) FILTER (bad) AS errors FROM w"""
ORACLE_SQL["integrity_verdict"] = f"""WITH u AS ({ORACLE_SQL['unique_pairs']}), x AS (SELECT count(*) FILTER (client_name = hit_name) AS e, count(*) FILTER (disposition_code = 'DISP_GIVEN_NAME_GENDER_VARIANT') AS g FROM u)
SELECT CAST(20 AS BIGINT) AS exact_planned, e AS exact_emitted, CAST(15 AS BIGINT) AS gender_planned, g AS gender_emitted, e = 20 AND g = 15 AS ok FROM x"""
ORACLE_SQL["closure_report"] = f"""WITH {PAIRS} SELECT disposition_code, count(*) AS n, 'x' AS example FROM p WHERE k % 3 = 0 GROUP BY disposition_code"""
ORACLE_SQL["model_load"] = f"WITH {FLOORS} SELECT CAST(sum(CASE WHEN code = 'DISP_EXACT_NAME_MATCH' THEN 0 ELSE quota - CAST(floor(0.3 * quota) AS BIGINT) END) AS BIGINT) AS asked, CAST(201 - 4 - floor(0.3 * (100 - 4)) - floor(0.3 * (101 - 4)) AS BIGINT) AS free_running FROM fl"

_QUOTAS = f"""qt AS (SELECT code, quota FROM {apportioned('(SELECT code, 1.0 AS weight FROM ' + values([(c,) for c in v.TRUE_POSITIVE], 'z(code)') + ') y', '260')} a
  UNION ALL SELECT code, quota FROM {apportioned('(SELECT code, 1.0 AS weight FROM ' + values([(c,) for c in v.FALSE_POSITIVE], 'z(code)') + ') y', '120')} b)"""
_NAMED = {"DISP_MINOR_TYPO": "mut_typo", "DISP_TOKEN_ORDER_SWAP": "mut_order_swap", "DISP_MIDDLE_NAME_ABBREVIATED": "mut_middle_abbrev", "DISP_MIDDLE_INITIAL_EXPANDED": "mut_middle_expand",
          "DISP_MIDDLE_NAME_OMITTED": "mut_middle_omit", "DISP_TRANSLITERATION_VARIANT": "mut_translit", "DISP_DIACRITIC_STRIPPED": "mut_diacritic", "DISP_COMPOUND_NAME_RESTRUCTURED": "mut_compound",
          "DISP_EXACT_NAME_MATCH": "mut_exact", "DISP_SURNAME_CONFLICT": "mut_surname_swap", "DISP_MIDDLE_NAME_CONFLICT": "mut_middle_conflict", "DISP_PHONETIC_SURNAME_DIVERGENCE": "mut_phonetic",
          "DISP_GIVEN_NAME_GENDER_VARIANT": "mut_gender"}


def _from(clients: str, code: str) -> str:
    """Candidates of a code from the clients that a relation (code, client_name) has for it."""
    own = MUTATIONS[_NAMED[code]].replace("FROM clients)", f"FROM (SELECT client_name FROM {clients} WHERE code = '{code}') own)", 1)
    return f"SELECT code, client_name, variant_ix, hit_name, matching_text, thinking FROM ({own}) m"


# The clients of the test tables are enough for each quota, so neither made-up names nor a second round are in here.
ORACLE_SQL["balanced_alerts"] = f"""WITH {CAPS}, {_QUOTAS}, need AS (SELECT code, quota, greatest(64, CAST(ceil(4.0 * quota / greatest(1, least({get(v.VARIANTS, 'code')}, 4))) AS BIGINT)) AS need FROM qt),
sz AS (SELECT code, count(DISTINCT client_name) AS size FROM caps GROUP BY code),
th AS (SELECT DISTINCT code, client_name FROM caps JOIN need USING (code) JOIN sz USING (code)
  WHERE size <= need OR ('0x' || substr(md5(client_name || code || '42'), 1, 5))::BIGINT < floor(1048576 * least(1.0, 1.5 * need / size) + 1)),
cd AS ({' UNION ALL '.join(_from('th', c) for c in v.CODES)}),
pd AS (SELECT *, CASE WHEN len(c) = 0 THEN [] ELSE list_filter(range(1, least(len(c), len(h)) + 1), lambda i: lower(c[i]) <> lower(h[i])) END AS d
  FROM (SELECT *, code AS disposition_code, {toks('client_name')} AS c, {toks('hit_name')} AS h FROM cd) q),
dr AS (SELECT pd.* FROM pd JOIN need USING (code) JOIN sz USING (code) WHERE ('0x' || substr(md5(code || '|' || client_name || '|' || hit_name || '|42'), 1, 5))::BIGINT
  < floor(1048576 * least(1.0, 1.5 * greatest(2 * quota, 2000) / greatest(1.0, least(size, 1.5 * need) * {get(v.VARIANTS, 'code')})) + 1)),
ok AS (SELECT * FROM dr WHERE {_problem()} IS NULL),
sc AS (SELECT code, CAST(count(*) AS DOUBLE) / any_value(quota) AS ratio FROM ok JOIN qt USING (code) GROUP BY code),
rk AS (SELECT ok.*, ratio, quota, md5(code || '|' || client_name || '|' || hit_name || '|42') AS rank FROM ok JOIN sc USING (code) JOIN qt USING (code)),
un AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(client_name)), lower(trim(hit_name)) ORDER BY ratio, code, rank, variant_ix) AS rn FROM rk),
sl AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY rank, variant_ix) AS slot FROM un WHERE rn = 1)
SELECT client_name, hit_name, matching_text, code AS disposition_code, {LABELS}[code] AS disposition_label, thinking, {get(v.DECISIONS, 'code')} AS decision, 'rule_based' AS created_by FROM sl WHERE slot <= quota"""
ORACLE_SQL["column_choice"] = f"""WITH c(k, cols, wanted) AS (VALUES (0, ['id', ' Client_Name ', 'name'], NULL), (1, ['id', 'x'], 'x'), (2, ['id', 'x'], NULL), (3, ['a', 'FULL_NAME'], 'b'), (4, ['HitName', 'Individual_Name'], 'Individual_Name'), (5, ['name'], 'Name'))
SELECT CAST(k AS BIGINT) AS k, CASE WHEN list_contains(cols, wanted) THEN wanted ELSE coalesce(list_filter(cols, lambda x: list_contains({arr(v.NAME_COLUMNS)}, lower(trim(x))))[1], cols[1]) END AS chosen FROM c"""
ORACLE_SQL["model_choice"] = """WITH c(k, wanted, models) AS (VALUES (0, 'Gemma4:31b Cloud', ['x', 'gemma4:31b-cloud']), (1, 'gemma4:9b', ['llama:1b', 'gemma4:31b']), (2, 'phi', ['tiny-phi:2', 'x']), (3, 'y', ['x']), (4, 'llama:1b', ['llama:2b', 'llama:1b'])),
n AS (SELECT *, replace(lower(trim(wanted)), ' ', '-') AS t FROM c)
SELECT CAST(k AS BIGINT) AS k, coalesce(list_filter(models, lambda m: replace(lower(trim(m)), ' ', '-') = t OR (contains(m, ':') AND contains(t, ':') AND string_split(m, ':')[1] = string_split(t, ':')[1]))[1],
  list_filter(models, lambda m: contains(lower(m), t))[1]) AS chosen FROM n"""
ORACLE_SQL["parsed_weights"] = "SELECT regexp_extract(x, '\"(\\w+)\"', 1) AS code, CAST(trim(regexp_extract(x, ':(.*)', 1)) AS DOUBLE) AS weight FROM (SELECT unnest(string_split(trim('{\"DISP_MINOR_TYPO\": 3, \"DISP_SURNAME_CONFLICT\": 0.5}', '{}'), ',')) AS x) q"
ORACLE_SQL["parsed_lists"] = """WITH c(k, x) AS (VALUES (0, ' disp_minor_typo, DISP_EXACT_NAME_MATCH ,,'), (1, ''), (2, 'cs_CZ'), (3, ' fr_FR ,de_DE')),
p AS (SELECT k, x, list_filter(list_transform(string_split(x, ','), lambda y: trim(y)), lambda y: y <> '') AS xs FROM c)
SELECT CAST(k AS BIGINT) AS k, array_to_string(list_sort(list_transform(xs, lambda y: upper(y))), ',') AS excludes, CASE WHEN x <> '' THEN array_to_string(xs, ',') END AS locales FROM p"""
ORACLE_SQL["unknown_codes"] = f"SELECT code, NOT list_contains({arr(v.CODES)}, code) AS error FROM (SELECT unnest({arr([*v.CODES, 'DISP_OTHER', '', 'disp_minor_typo'])}) AS code) q"


def _of(relation: str, code: str) -> str:
    """Candidates of a code from the client names of a relation."""
    return _from(f"(SELECT '{code}' AS code, client_name FROM {relation}) rel", code)


def _one_each(frame: str, code: str) -> str:
    """For each (client_name, attempt) of a relation one candidate of the code, by hash."""
    return f"""SELECT code, client_name, attempt, hit_name, matching_text, thinking FROM (
      SELECT m.*, f.attempt, row_number() OVER (PARTITION BY m.client_name, f.attempt ORDER BY md5(m.hit_name || '|' || f.attempt || '|42'), m.variant_ix) AS turn
      FROM {frame} f JOIN ({_of(f'(SELECT DISTINCT client_name FROM {frame})', code)}) m ON m.client_name = f.client_name) q WHERE turn = 1"""


def _free(name: str, decision: str, want: int) -> str:
    """CTEs of one decision's free-running pairs: one operator by hash for each client and attempt, fallbacks, a second mutation from attempt 3 on."""
    fp = decision == v.DISQUALIFY
    last = "DISP_SURNAME_CONFLICT" if fp else "DISP_MINOR_TYPO"
    menu = ["DISP_SURNAME_CONFLICT", "DISP_MIDDLE_NAME_CONFLICT", "DISP_PHONETIC_SURNAME_DIVERGENCE"] if fp else ["DISP_MINOR_TYPO", "DISP_TOKEN_ORDER_SWAP", "MIDDLE", "DISP_TRANSLITERATION_VARIANT", "DISP_DIACRITIC_STRIPPED", "DISP_COMPOUND_NAME_RESTRUCTURED", "DISP_MIDDLE_NAME_OMITTED"]
    fallback = {} if fp else {"DISP_TRANSLITERATION_VARIANT": "DISP_MINOR_TYPO", "DISP_DIACRITIC_STRIPPED": "DISP_MINOR_TYPO", "DISP_COMPOUND_NAME_RESTRUCTURED": "DISP_TOKEN_ORDER_SWAP"}
    key = "client_name || '|' || attempt"
    out = [f"{name}t AS (SELECT client_name, attempt, len({toks('client_name')}) AS size, {arr(menu)}[{pick(key, f'menu/{decision}', len(menu))} + 1] AS wanted FROM clients, range(4) a(attempt))"]
    parts = []
    for k, code in enumerate(menu):
        if code == "MIDDLE":
            three, two = (f"(SELECT client_name, attempt FROM {name}t WHERE wanted = 'MIDDLE' AND size {x})" for x in (">= 3", "= 2"))
            parts += [_one_each(three, "DISP_MIDDLE_NAME_ABBREVIATED"), _one_each(three, "DISP_MIDDLE_INITIAL_EXPANDED"), _one_each(two, "DISP_MIDDLE_NAME_OMITTED")]
            continue
        out.append(f"{name}m{k} AS ({_one_each(f'''(SELECT client_name, attempt FROM {name}t WHERE wanted = '{code}')''', code)})")
        parts.append(f"SELECT * FROM {name}m{k}")
        if code in fallback:
            out.append(f"{name}r{k} AS (SELECT client_name, attempt FROM {name}t ANTI JOIN {name}m{k} USING (client_name, attempt) WHERE wanted = '{code}')")
            parts.append(_one_each(f"{name}r{k}", fallback[code]))
    boundary, principle = ("BOUNDARY_SURNAME_CONFLICT", "PRINCIPLE_FP_DISTINCT") if fp else ("BOUNDARY_MINOR_TYPO", "PRINCIPLE_TP_IDENTITY")
    said = lambda kind: f"{arr(v.WORDING[kind])}[{pick(key, kind, len(v.WORDING[kind]))} + 1]"
    uneven = f"CASE WHEN least(len(c), len(h)) > 2 THEN ({note(join('c[2:-2]'), join('h[2:-2]'))}) ELSE 'absent from one or both records' END"
    mid = f"CASE WHEN len(c) = len(h) THEN ({mid_note('c', 'h')}) ELSE {uneven} END"
    thinking = f"""'Client ''' || client_name || ''' vs hit ''' || hit_name || '''. Given: ' || ({note('c[1]', 'h[1]')}) || '. Middle: ' || ({mid}) || '. Surname: ' || ({note('c[-1]', 'h[-1]')})
      || '. ' || {said(boundary)} || ' ' || {said(principle)} || ' Therefore: {last} -> {decision}.'"""
    cols = "code, client_name, attempt, hit_name, matching_text, thinking"
    out += [
        f"{name}f AS ({' UNION ALL '.join(f'SELECT {cols} FROM ({p}) p' for p in parts)})",
        f"{name}b AS (SELECT DISTINCT hit_name AS client_name, attempt FROM {name}f WHERE attempt >= 3)",
        f"{name}g AS ({_one_each(f'{name}b', last)})",
        f"{name}a AS (SELECT *, {toks('client_name')} AS c, {toks('hit_name')} AS h FROM (SELECT f.client_name, f.attempt, g.hit_name, g.matching_text FROM {name}f f JOIN {name}g g ON g.client_name = f.hit_name AND g.attempt = f.attempt WHERE f.attempt >= 3) q)",
        f"{name}w AS (SELECT {cols} FROM {name}f WHERE attempt < 3 UNION ALL SELECT '{last}' AS code, client_name, attempt, hit_name, matching_text, {thinking} AS thinking FROM {name}a)",
        f"{name}i AS ({_one_each(f'(SELECT client_name, attempt FROM {name}w WHERE lower(trim(client_name)) = lower(trim(hit_name)))', last)})",
        f"{name} AS (SELECT {cols}, {want} AS want FROM (SELECT {cols} FROM {name}w WHERE lower(trim(client_name)) <> lower(trim(hit_name)) UNION ALL SELECT {cols} FROM {name}i) z)",
    ]
    return ",\n".join(out)


_GENDER = get(v.GENDER, fold(f"({toks('client_name')})[1]"))
# The clients of the test tables are enough for one round of four attempts and for real cross-gender clients of either kind.
ORACLE_SQL["legacy_alerts"] = f"""WITH {CAPS}, {_free('tp', v.ESCALATE, 1)}, {_free('fp', v.DISQUALIFY, 2)},
re AS (SELECT client_name FROM clients ORDER BY md5(client_name || 'exact42'), client_name LIMIT 10),
gc AS (SELECT client_name, gender, row_number() OVER (PARTITION BY gender ORDER BY md5(client_name || '42'), client_name) AS turn FROM (SELECT client_name, {_GENDER} AS gender FROM (SELECT client_name FROM caps WHERE code = 'DISP_GIVEN_NAME_GENDER_VARIANT') k) q WHERE gender IS NOT NULL),
gs AS (SELECT client_name, turn FROM gc WHERE turn <= 4 ORDER BY turn, gender DESC LIMIT 7),
al AS (SELECT code, client_name, 0 AS attempt, hit_name, matching_text, thinking, 0 AS want FROM ({_of('re', 'DISP_EXACT_NAME_MATCH')}) x
  UNION ALL SELECT code, m.client_name, turn, hit_name, matching_text, thinking, -1 FROM ({_of('gs', 'DISP_GIVEN_NAME_GENDER_VARIANT')}) m JOIN gs ON gs.client_name = m.client_name
  UNION ALL SELECT * FROM tp UNION ALL SELECT * FROM fp),
rk AS (SELECT *, md5(code || '|' || client_name || '|' || hit_name || '|42') AS rank FROM al),
un AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(client_name)), lower(trim(hit_name)) ORDER BY want, attempt, rank) AS rn FROM rk),
sl AS (SELECT *, row_number() OVER (PARTITION BY want ORDER BY attempt, rank) AS slot FROM un WHERE rn = 1)
SELECT client_name, hit_name, matching_text, code AS disposition_code, {LABELS}[code] AS disposition_label, thinking, {get(v.DECISIONS, 'code')} AS decision, 'rule_based' AS created_by
FROM sl WHERE slot <= CASE want WHEN -1 THEN 2 WHEN 0 THEN 10 WHEN 1 THEN 50 ELSE 38 END"""
