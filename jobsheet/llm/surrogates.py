"""Surrogates for personal data, with DataFrame functions only (operator 6).

A text is cut at its entities by one pattern.  An entity is one or more parts,
each of a kind (mailbox, domain, phone, card, ...), and a part's surrogate is
a keyed hash of its normalised form, written in the part's own format: digits
for digits, letters for letters of the same case and script, valid check
digits (cards, account numbers), names by gender, script, hyphens and capitals.  So the same part has the same surrogate
in every document, without a join.

Collision checks: over the distinct parts of the corpus, no two of a kind may
share a surrogate and none may be a part that occurs.  Those that do are hashed
again with the next attempt number until none is left.  Only parts with a later
attempt are joined back: their number is counted, and up to ``MAX_BROADCAST`` they
are broadcast, as are the texts that hold them; beyond that both are joined by hash.

Defined results: a null text stays null, an empty one empty; repeated rows get
equal surrogates; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsheet.llm.common import keep

MAX_BROADCAST = 10_000
MAX_ATTEMPTS = 40

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}’'-]+"
_MALE = r"(?:Mr|Herr|Monsieur|Señor|Sr|Господин|Г-н|Κύριος)"
_FEMALE = r"(?:Mrs|Miss|Ms|Frau|Madame|Mme|Señora|Sra|Госпожа|Г-жа|Κυρία)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){1,30}+",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?<![\p{L}\d])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)|\+\d{8,14}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "secret": r"(?<![\p{L}\d])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,64})(?![\p{L}\d])|(?<=password=)[^\s\"']+",
    "person": rf"(?<![\p{{L}}])(?:{_MALE}|{_FEMALE})\.? {_NAME}(?: {_NAME}){{0,2}}",
}
def _one_of(*kinds: str) -> str:
    return "|".join(f"(?:{PATTERNS[k]})" for k in kinds)


#: Where no entity begins: at white space, and inside a word of Latin small letters.
_NOT_HERE = r"(?!\s|[a-z](?<=[a-z][a-z]))"
#: All but mailboxes, in this order where two begin at the same place; each begins with what its look-ahead names.
_NO_MAILBOX = rf"(?=[\d+(])(?:{_one_of('ip', 'card', 'phone', 'ssn')})|(?=[A-Z])(?:{_one_of('iban')})|{_one_of('secret')}|(?=\p{{Lu}})(?:{_one_of('person')})"
#: One pattern for all; a text without @ has no mailbox, so the shorter one finds the same in it.
ENTITY = f"{_NOT_HERE}(?:{_one_of('email')}|{_NO_MAILBOX})"
ENTITY_NO_MAILBOX = f"{_NOT_HERE}(?:{_NO_MAILBOX})"

#: Syllables and endings that names are built of, by script; endings by gender.
SYLLABLES = {"latin": "ba be da de fa ga ka la le li ma mi na no pa ra re sa ta ve".split(),
             "cyrillic": "ба ве да га ка ла ле ли ма ми на но па ра ре са та ти ву зо".split(),
             "greek": "βα γε δα θε κα λα λε λι μα μι να νο πα ρα ρε σα τα τε φο χι".split()}
ENDINGS = {"latin": {"m": "lo ro nus ker".split(), "f": "la ra nia lina".split()},
           "cyrillic": {"m": "лад мир слав рик".split(), "f": "лина мира слава рика".split()},
           "greek": {"m": "νος ρος λης μος".split(), "f": "να ρα λη μια".split()}}


def _lit(words: list[str]) -> str:
    return "array(" + ",".join("'" + w + "'" for w in words) + ")"


def _full(pattern: str) -> str:
    return "'" + ("^(?:" + pattern + ")$").replace("\\", "\\\\").replace("'", "\\'") + "'"


def _kind(e: str) -> str:
    order = ("email", "ip", "card", "phone", "ssn", "iban", "secret", "person")
    cases = " ".join(f"WHEN {e} RLIKE {_full(PATTERNS[k])} THEN '{k}'" for k in order if k != "secret")
    return f"CASE {cases} ELSE 'secret' END"


def _script(e: str) -> str:
    return f"CASE WHEN {e} RLIKE '\\\\p{{IsCyrillic}}' THEN 'cyrillic' WHEN {e} RLIKE '\\\\p{{IsGreek}}' THEN 'greek' ELSE 'latin' END"


def _digits(e: str) -> str:
    return f"regexp_replace({e}, '[^0-9]', '')"


def parts_sql(e: str) -> str:
    """An entity's parts: array of (kind, norm).  Given names carry gender and script in their kind."""
    gender = f"CASE WHEN {e} RLIKE '^{_FEMALE}' THEN 'f' ELSE 'm' END"
    names = f"slice(split({e}, ' '), 2, 9)"
    return f"""CASE {_kind(e)}
      WHEN 'email' THEN array(struct('mailbox' AS kind, lower({e}) AS norm), struct('domain' AS kind, lower(substring_index({e}, '@', -1)) AS norm))
      WHEN 'ip' THEN array(struct('ip' AS kind, {e} AS norm))
      WHEN 'phone' THEN array(struct('phone' AS kind, {_digits(e)} AS norm))
      WHEN 'card' THEN array(struct('card' AS kind, {_digits(e)} AS norm))
      WHEN 'ssn' THEN array(struct('ssn' AS kind, {_digits(e)} AS norm))
      WHEN 'iban' THEN array(struct('iban' AS kind, replace({e}, ' ', '') AS norm))
      WHEN 'person' THEN transform({names}, (w, i) -> struct(
        concat(CASE WHEN i = size({names}) - 1 THEN 'family' ELSE concat('given_', {gender}) END, '_', {_script("w")}) AS kind, lower(w) AS norm))
      ELSE array(struct('secret' AS kind, {e} AS norm)) END"""


def _byte(s: str, i: str) -> str:
    return f"cast(conv(substr({s}, 2 * (({i}) % 64) + 1, 2), 16, 10) AS int)"


#: Letters that stand for letters of their script and case.
LETTERS = {"IsCyrillic": ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"), "IsGreek": ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
           "L": ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")}


def _swap(text: str, s: str, first: str) -> str:
    """Each digit and letter of ``text`` after its first ``first`` characters by one of its kind, case and script (Latin for scripts without letters here)."""
    letters = " ".join(f"""WHEN c RLIKE '\\\\p{{{x}}}' THEN IF(c RLIKE '\\\\p{{Lu}}', substr('{up}', 1 + {_byte(s, 'j + 1')} % {len(up)}, 1),
      substr('{low}', 1 + {_byte(s, 'j + 1')} % {len(low)}, 1))""" for x, (low, up) in LETTERS.items())
    return f"""array_join(transform(split({text}, ''), (c, j) -> CASE WHEN j < {first} THEN c
      WHEN c RLIKE '[0-9]' THEN cast({_byte(s, 'j + 1')} % 10 AS string) {letters} ELSE c END), '')"""


def _iban(d: str) -> str:
    """``d`` with the check digits (third and fourth character) that make it 1 modulo 97, letters counting as 10 to 35."""
    c = f"substr(concat(substr({d}, 5), substr({d}, 1, 2), '00'), i, 1)"
    left = f"""aggregate(sequence(1, char_length({d})), 0, (a, i) -> IF({c} RLIKE '[0-9]', (a * 10 + cast(IF({c} RLIKE '[0-9]', {c}, '0') AS int)) % 97,
      (a * 100 + ascii({c}) - 55) % 97))"""
    return f"concat(substr({d}, 1, 2), lpad(cast(98 - {left} AS string), 2, '0'), substr({d}, 5))"


def _luhn(d: str) -> str:
    """``d`` with its last digit made the Luhn check digit of the others."""
    v = f"cast(substr({d}, i, 1) AS int)"
    total = f"""aggregate(sequence(1, char_length({d}) - 1), 0, (a, i) -> a + CASE WHEN (char_length({d}) - i) % 2 = 1
      THEN CASE WHEN {v} > 4 THEN 2 * {v} - 9 ELSE 2 * {v} END ELSE {v} END)"""
    return f"concat(substr({d}, 1, char_length({d}) - 1), cast((10 - {total} % 10) % 10 AS string))"


def part_surrogate(kind: str, norm: str, attempt: str, key: str) -> str:
    """SQL of a part's surrogate in normal form."""
    key = key.replace("\\", "\\\\").replace("'", "\\'")
    seed = f"sha2(concat('{key}', '|', {kind}, '|', {norm}, '|', cast({attempt} AS string)), 512)"
    s, n = "s", norm

    def name(script: str, ending: str | None) -> str:
        syl = SYLLABLES[script]
        body = f"array_join(transform(sequence(1, 3 + {attempt}), i -> element_at({_lit(syl)}, 1 + {_byte(s, 'i + 11 * k')} % {len(syl)})), '')"
        end = f", element_at({_lit(ENDINGS[script][ending])}, 1 + {_byte(s, '11 * k')} % {len(ENDINGS[script][ending])})" if ending else ""
        return f"array_join(transform(split({n}, '-'), (side, k) -> initcap(concat({body}{end}))), '-')"  # a name for each side of a hyphen

    names = " ".join(f"WHEN 'given_{g}_{x}' THEN {name(x, g)}" for x in SYLLABLES for g in "mf") + " " \
        + " ".join(f"WHEN 'family_{x}' THEN {name(x, None)}" for x in SYLLABLES)
    # Short texts have little room: later attempts grow by a character each.
    more = f"array_join(transform(sequence(1, greatest(1, {attempt} - 2)), i -> IF({attempt} > 2, cast({_byte(s, 'i + 40')} % 10 AS string), '')), '')"
    hexed = f"array_join(transform(sequence(1, char_length({n})), i -> substr(s, (2 * i) % 128 + 1, 1)), '')"
    body = f"""CASE {kind}
      WHEN 'mailbox' THEN concat({_swap(f"substring_index({n}, '@', 1)", s, "0")}, {more})
      WHEN 'domain' THEN concat({_swap(f"regexp_replace({n}, '[.][^.]*$', '')", s, "0")}, {more}, '.', substring_index({n}, '.', -1))
      WHEN 'ip' THEN concat(CASE WHEN {attempt} < 4 THEN '10' WHEN {attempt} < 8 THEN cast(240 + {_byte(s, '4')} % 15 AS string) ELSE cast(1 + {_byte(s, '4')} % 223 AS string) END, '.', {_byte(s, '1')}, '.', {_byte(s, '2')}, '.', {_byte(s, '3')})
      WHEN 'phone' THEN {_swap(n, s, f"greatest(0, char_length({n}) - 10)")}
      WHEN 'ssn' THEN IF({attempt} < 4, concat('9', substr({_swap(n, s, "1")}, 2)), {_swap(n, s, "0")})
      WHEN 'iban' THEN {_swap(n, s, "2")}
      WHEN 'secret' THEN concat(CASE WHEN {n} RLIKE '^[0-9a-f]+$' THEN {hexed} ELSE {_swap(n, s, f"IF({n} LIKE 'AKIA%', 4, 0)")} END, {more})
      {names} ELSE {_swap(n, s, "1")} END"""
    # one hash per part: bound once, used for every character
    made = f"element_at(transform(array({seed}), s -> {body}), 1)"
    return f"""element_at(transform(array({made}), d -> CASE WHEN {kind} = 'card' THEN {_luhn('d')} WHEN {kind} = 'iban' THEN {_iban('d')} ELSE d END), 1)"""


def entity_surrogate(e: str, attempts: str | None, key: str) -> str:
    """SQL of the replacement of entity ``e``; ``attempts`` is a map from kind|norm to a later attempt."""
    def swapped(p: str) -> str:
        attempt = f"coalesce(element_at({attempts}, concat({p}.kind, '|', {p}.norm)), 0)" if attempts else "0"
        return part_surrogate(f"{p}.kind", f"{p}.norm", attempt, key)

    shaped = f"""array_join(transform(sequence(1, char_length({e})), i -> CASE WHEN substr({e}, i, 1) RLIKE '[0-9A-Za-z]'
      THEN substr(r[0], char_length(regexp_replace(substr({e}, 1, i), '[^0-9A-Za-z]', '')), 1) ELSE substr({e}, i, 1) END), '')"""
    return f"""element_at(transform(array({parts_sql(e)}), parts -> element_at(transform(array(transform(parts, p -> {swapped("p")})), r -> CASE
      WHEN parts[0].kind = 'mailbox' THEN concat(r[0], '@', r[1])
      WHEN parts[0].kind IN ('phone', 'card', 'ssn', 'iban') THEN {shaped}
      WHEN parts[0].kind IN ('ip', 'secret') THEN r[0]
      ELSE concat(substring_index({e}, ' ', 1), ' ', array_join(transform(r, (name, at) -> element_at(transform(array(split({e}, ' ')[at + 1]),
        word -> IF(word = upper(word) AND char_length(word) > 1, upper(name), name)), 1)), ' ')) END), 1)), 1)"""


def entities(text: Column) -> Column:
    return F.when(text.contains("@"), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))) \
        .otherwise(F.regexp_extract_all(text, F.lit(ENTITY_NO_MAILBOX), F.lit(0)))


def found_entities(docs: DataFrame, text_col: str) -> DataFrame:
    """h (hash of the text) and e (its distinct entities) of the texts that have any, written once for all later steps."""
    found = docs.select(F.xxhash64(F.col(f"`{text_col}`")).alias("h"), F.array_distinct(entities(F.col(f"`{text_col}`"))).alias("e"))
    return keep(found.filter(F.size("e") > 0), "pii-entities")


def corpus_parts(found: DataFrame) -> DataFrame:
    """The distinct (kind, norm) of the corpus; repeated entities are combined before the shuffle."""
    found = found.select(F.explode("e").alias("e")).distinct()
    return found.select(F.explode(F.expr(parts_sql("e"))).alias("p")).select("p.kind", "p.norm").distinct()


def later_attempts(parts: DataFrame, key: str) -> DataFrame:
    """(part, attempt) of the parts whose first surrogate clashes; raises if a kind has no room left."""
    parts = keep(parts, "pii-parts")
    later = None
    for _ in range(MAX_ATTEMPTS):
        table = parts.withColumn("attempt", F.lit(0)) if later is None else parts.join(later, ["kind", "norm"], "left") \
            .withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        made = table.withColumn("surrogate", F.expr(part_surrogate("kind", "norm", "attempt", key)))
        # Of parts with one surrogate the least attempt, then the least norm, keeps it: settled ones stay.
        first = made.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n"))
        real = parts.select("kind", F.col("norm").alias("surrogate"))
        shared = first.filter("n > 1").select("kind", "surrogate", F.col("first.norm").alias("keeper"))
        taken = first.join(real, ["kind", "surrogate"], "left_semi").select("kind", "surrogate", F.lit(None).cast("string").alias("keeper"))
        clash = shared.join(taken, ["kind", "surrogate"], "left_anti").unionByName(taken)
        again = made.join(clash, ["kind", "surrogate"]).filter(F.col("keeper").isNull() | (F.col("norm") != F.col("keeper")))
        again = keep(again.select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "pii-clashes")
        if again.isEmpty():
            return later
        if later is not None:
            again = later.join(again, ["kind", "norm"], "left_anti").unionByName(again)
        later = keep(again, "pii-attempts")
    raise ValueError("no distinct surrogates are left for some kind of personal data")


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of the text replaced; columns and their order stay.  ``count_col`` adds the number of
    the text's entities, 0 where it is null."""
    found = found_entities(docs, text_col)
    later = later_attempts(corpus_parts(found), key)
    columns = docs.columns
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text_col}`").alias("t"))
    attempts = None
    if later is not None:
        named = later.select(F.concat_ws("|", "kind", "norm").alias("part"), "attempt")
        if later.count() <= MAX_BROADCAST:
            named = F.broadcast(named)
        # texts with a later attempt, by text hash: equal texts need equal maps
        parts = found.select("h", F.explode("e").alias("e")).distinct().select("h", F.explode(F.expr(parts_sql("e"))).alias("p")) \
            .select("h", F.concat_ws("|", "p.kind", "p.norm").alias("part")).distinct()
        maps = keep(parts.join(named, "part").groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("part", "attempt"))).alias("m")), "pii-maps")
        if (maps.select(F.sum(F.size("m") + 1)).first()[0] or 0) <= MAX_BROADCAST:  # all other texts stay where they are
            maps = F.broadcast(maps)
        source = source.withColumn("h", F.xxhash64("t")).join(maps, "h", "left") \
            .withColumn("m", F.coalesce("m", F.expr("cast(map() AS map<string,int>)")))
        attempts = "m"
    pattern = ENTITY.replace("\\", "\\\\").replace("'", "\\'")
    cut = source.withColumn("e", entities(F.col("t"))).withColumn("gaps", F.expr(f"CASE WHEN size(e) > 0 THEN split(t, '{pattern}', -1) END"))
    new = F.expr(f"""CASE WHEN size(e) > 0 THEN concat(gaps[0], array_join(transform(e, (x, k) -> concat(
      {entity_surrogate('x', attempts, key)}, gaps[k + 1])), '')) ELSE t END""")
    out = cut.withColumn("new", new)
    count = [] if count_col is None else [F.greatest(F.coalesce(F.size("e"), F.lit(0)), F.lit(0)).alias(count_col)]
    return out.select(*[F.col("new").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in columns], *count)
