"""Surrogate generation for personal data, in DataFrame operations only.

1.  One pattern finds e-mail addresses, secrets (``password=``, ``token = ``),
    payment card numbers, telephone and social security numbers, IPv4
    addresses, and names behind a form of address.
2.  A mention becomes one or two *entities*: a type and a canonical form (a
    number's digits, a lower-case address, a given or a family name with its
    gender and script).  Equal entities get equal surrogates wherever and
    however they are written, also when a name is given in full once and by
    its family name later.
3.  A surrogate is drawn from a keyed hash of the entity: same length, same
    classes of characters and script, a card keeps a valid check digit, a
    given name its gender.
    A telephone number keeps its country code, an e-mail address the depth of
    its domain, which ends in a reserved name.
4.  Collision checks: two entities of a type never share a surrogate, and no
    surrogate equals a detected entity; the losers draw again until none is
    left, longer ones after a few failures (an address its local part, a
    number more digits, an IPv4 address a fifth part), so the draws end.
5.  Surrogates go back into the text in the mention's own format.

The distinct entities are aggregated before anything else is done with them;
only documents with mentions are shuffled.  An entity in very many documents
is a hot key of one inner join, which adaptive execution splits.

Cases
-----
* null, empty and clean texts are returned as they are;
* a secret or local part without a letter or digit becomes small letters;
* numbers that only look like cards (bad check digit) are left alone;
* a telephone number is found with a country code (``+``, with or without
  separators), with its area code in brackets, as three, three and four digits
  (space, dot or hyphen between), or as ten digits that are valid in North
  America; national numbers grouped otherwise, quoted local parts and names
  without a form of address are not found;
* repeated rows and equal ids: each row is treated by itself, alike;
* empty table: empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import cut_lineage

# Forms of address by gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Госпожа")
NEUTRAL = ("Dr", "Prof")
# Given names that surrogates start from, by gender and script.
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "David", "Erik", "Felix", "Georg", "Hugo", "Ivan", "Jonas",
                     "Karim", "Leon", "Marco", "Noah", "Oscar", "Paul", "Robin", "Simon", "Tom", "Victor"),
    ("f", "latin"): ("Alice", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia",
                     "Karin", "Laura", "Maria", "Nora", "Olivia", "Paula", "Rosa", "Sofia", "Tina", "Vera"),
    ("n", "latin"): ("Alex", "Chris", "Dana", "Eli", "Jamie", "Jules", "Kim", "Lou", "Noel", "Robin"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл", "Лев", "Павел"),
    ("f", "cyrillic"): ("Алла", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лидия", "Нина", "Ольга", "Раиса"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя"),
}
SYLLABLES = {
    "latin": ("ba", "cor", "dan", "el", "fer", "gil", "hol", "ir", "jan", "kel", "lo", "mar", "nev", "or", "pel",
              "quin", "ros", "sten", "tor", "ul", "ver", "wes", "yor", "zan"),
    "cyrillic": ("ба", "вол", "гор", "дан", "ер", "жан", "зор", "ков", "лев", "мар", "нов", "ор", "пет", "рос",
                 "сал", "тар", "фед", "хол", "чер", "шин"),
}

_ADDRESS = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A country code, before a separator or, by the plan of the codes, in a run of digits.
_CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_COUNTRY = rf"^\+(?:\d{{1,3}}(?=[ .\-(])|{_CODE}(?=\d{{4,}}$))"
# What stands before an address without belonging to it: Markdown emphasis, dots, dashes.
_LEAD = r"^[._%+\-]+(?=[\p{L}\p{N}])"
_SECRET = r"(?i:password|passwd|pwd|token|secret|api_?key)"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Surrogates of an entity's own length may run out: after WIDEN_AFTER draws
# each further one is a character longer, up to WIDEN_MOST.
WIDEN_AFTER, WIDEN_MOST = 2, 24
_NAME_WORD = r"\p{Lu}[\p{L}'’\-]*\p{L}"
# Alternatives in order; each starts at the border of a word, so that long
# words are not searched from every letter.  An address is searched from the
# first of the characters it may hold; _LEAD is set apart later.
PATTERN = "|".join((
    rf"(?<![\p{{L}}\p{{N}}_]){_SECRET} {{0,2}}[=:] {{0,2}}[\"']?[A-Za-z0-9_+/=.\-]{{8,}}",
    r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]+(?:\.[\p{L}\p{N}\-]+)*\.\p{L}{2,}",
    r"(?<![\p{L}\p{N}])(?:\d{4}([ \-])\d{4}\1\d{4}\1\d{4}|\d{4}([ \-])\d{6}\2\d{5}|\d{13,19})(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)",
    r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .\-]\d{2,4}(?:[ .\-]\d{2,4}){1,4}(?!\d)",
    r"(?<![\p{L}\p{N}+])\+\d{7,15}(?!\d)",
    r"(?<![\p{L}\p{N}.\-])\d{3}[ .\-]\d{3}[ .\-]\d{4}(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}+\-])(?<!\d[.,])[2-9]\d{2}[2-9]\d{6}(?![\p{L}\p{N}]|[.,]\d)",
    r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)",
    rf"(?<!\p{{L}})(?:{_ADDRESS})\.? {_NAME_WORD}(?: {_NAME_WORD})?",
))
# What a text with any mention has: a cheap test that most texts fail.
HINT = rf"[0-9@]|(?<!\p{{L}})(?:{_ADDRESS})\.? \p{{Lu}}|{_SECRET} {{0,2}}[=:]"


def _sub(text: Column, start, length) -> Column:
    """Part of a text; start and length may be columns."""
    return F.call_function("substring", F.col(text) if isinstance(text, str) else text,
                           *(x if isinstance(x, Column) else F.lit(x) for x in (start, length)))


def _mac(key: str, message: Column) -> Column:
    inner = F.sha2(F.concat(F.lit(key + "\x01"), message), 256)
    return F.sha2(F.concat(F.lit(key + "\x02"), inner), 512)


def _draws(key: str, message: Column, n: Column) -> Column:
    """At least ``n`` numbers from 0 to 65535 that follow from key and message."""
    rounds = F.sequence(F.lit(0), F.floor(n / 32).cast("int"))
    pairs = F.flatten(F.transform(rounds, lambda k: F.regexp_extract_all(
        _mac(key, F.concat_ws("\x03", message, k)), F.lit("...."), 0)))
    return F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int"))


def _pick(draw: Column, letters) -> Column:
    values = F.array(*map(F.lit, letters))
    return values[draw % len(letters)]


def _like(text: Column, draws: Column) -> Column:
    """Every letter and digit replaced by one of its class and script; hexadecimal texts stay so."""
    hexadecimal = text.rlike(r"^([0-9a-f]+|[0-9A-F]+)$")

    def one(i):
        c, d = _sub(text, i, 1), draws[i - 1]
        return (F.when(c.rlike(r"\d"), _pick(d, "0123456789"))
                .when(c.rlike(r"\p{IsCyrillic}"), F.when(c == F.lower(c), _pick(d, "абвгдежзиклмнопрстуфхцчшэюя"))
                      .otherwise(_pick(d, "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ")))
                .when(hexadecimal, F.when(c == F.lower(c), _pick(d, "abcdef")).otherwise(_pick(d, "ABCDEF")))
                .when(c.rlike(r"\p{Lu}"), _pick(d, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                .when(c.rlike(r"\p{L}"), _pick(d, "abcdefghijklmnopqrstuvwxyz"))
                .otherwise(c))
    return F.when(F.length(text) == 0, "").otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), ""))


def _veiled(text: Column, draws: Column) -> Column:
    """:func:`_like`, or small letters for a text without a letter or digit."""
    return F.when(text.rlike(r"[\p{L}\p{N}]"), _like(text, draws)).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: _pick(draws[i - 1], _LETTERS)), ""))


def _check_sum(digits: Column, double_last: bool) -> Column:
    """The check sum of card digits; ``double_last`` for digits without their check digit."""
    n = F.length(digits)

    def one(i):
        d = _sub(digits, i, 1).cast("int")
        twice = ((n - i) % 2) == F.lit(0 if double_last else 1)
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), n), one), F.lit(0), lambda a, x: a + x) % 10


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _type(hit: Column) -> Column:
    digits = _digits(hit)
    card = F.length(digits).between(13, 19) & hit.rlike(r"^\d[\d \-]*$")
    return (F.when(hit.rlike(rf"^{_SECRET} *[=:]"), "secret")
            .when(hit.contains("@"), "email")
            .when(hit.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
            .when(hit.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(card, F.when(_check_sum(digits, False) == 0, "card"))
            .when(hit.rlike(r"^[+(\d]"), "phone")
            .otherwise("name"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _atoms(hits: DataFrame) -> DataFrame:
    """One row per entity mention: ``row, pos, sub, type, canonical, surface``.

    ``sub`` orders the words of a name mention; a word that stays has no type.
    """
    typed = hits.withColumn("type", _type(F.col("hit")))
    whole = typed.where("type IS NULL OR type <> 'name'").select(
        "row", "pos", F.lit(0).alias("sub"), "type",
        F.when(F.col("type") == "email", F.lower(F.regexp_replace("hit", _LEAD, "")))
        .when(F.col("type") == "secret", F.regexp_extract("hit", r"[=:] {0,2}[\"']?(.*)$", 1))
        .when(F.col("type") == "phone", _digits(F.regexp_replace("hit", _COUNTRY, "")))
        .when(F.col("type").isin("card", "ssn"), _digits(F.col("hit")))
        .otherwise(F.col("hit")).alias("canonical"), F.col("hit").alias("surface"))
    words = typed.where("type = 'name'").select("row", "pos", F.split("hit", " ").alias("w")).select(
        "row", "pos", F.posexplode("w").alias("sub", "surface"), F.regexp_replace(F.col("w")[0], r"\.", "").alias("a"),
        F.size("w").alias("n"))
    gender = (F.when(F.col("a").isin(*MALE), "m").when(F.col("a").isin(*FEMALE), "f").otherwise("n"))
    names = words.select(
        "row", "pos", "sub",
        F.when(F.col("sub") == 0, None)
        .when(F.col("sub") == F.col("n") - 1, F.concat(F.lit("family-"), _script(F.col("surface"))))
        .otherwise(F.concat(F.lit("given-"), gender, F.lit("-"), _script(F.col("surface")))).alias("type"),
        F.initcap(F.lower("surface")).alias("canonical"), "surface")
    return whole.unionByName(names)


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` with the draws their surrogates are made of.

    The draws are columns of their own projections: inside one expression
    they would be hashed anew for every character.
    """
    domain = F.substring_index("canonical", "@", -1)
    return (entities
            .withColumn("_draws", _draws(key, F.concat_ws("\x03", "type", "canonical", "attempt"),
                                         F.length("canonical") + 8 + WIDEN_MOST))
            .withColumn("_domain_draws", F.when(F.col("type") == "email", _draws(
                key, F.concat_ws("\x03", F.lit("domain"), domain), F.length(domain))))
            .withColumn("_like", F.when(F.col("type").isin("ssn", "card", "phone", "secret"),
                                        _veiled(F.col("canonical"), F.col("_draws")))))


def _surrogate(kind: Column, canonical: Column, attempt: Column) -> Column:
    """The canonical form that stands for an entity, from the columns of :func:`_drawn`."""
    draws, domain_draws, like = F.col("_draws"), F.col("_domain_draws"), F.col("_like")
    extra = F.least(F.greatest(attempt - WIDEN_AFTER, F.lit(0)), F.lit(WIDEN_MOST)).cast("int")
    wider = lambda letters: F.when(extra == 0, "").otherwise(F.array_join(F.transform(
        F.sequence(F.lit(1), extra), lambda i: _pick(draws[F.length(canonical) + i], letters)), ""))
    digits, letters = wider("0123456789"), wider(_LETTERS)
    phone = F.concat(_pick(draws[F.length(canonical)], "23456789"), _sub(like, 2, 1 << 20), digits)
    local = F.substring_index(canonical, "@", 1)
    domain = F.substring_index(canonical, "@", -1)
    # A domain keeps its number of labels; its last two become reserved ones.
    depth = F.size(F.split(domain, r"\."))
    host = F.call_function("substring_index", domain, F.lit("."), depth - 2)
    tld = F.substring_index(domain, ".", -1)
    reserved = F.when(tld.isin("com", "net", "org"), F.concat(F.lit("example."), tld)).otherwise("example.org")
    new_domain = F.when(depth > 2, F.concat(_like(host, domain_draws), F.lit("."), reserved)).otherwise(reserved)
    octet = lambda i, low, n: (F.lit(low) + draws[i] % n).cast("string")
    card = F.concat(_sub(canonical, 1, 1), _sub(like, F.lit(2), F.length(canonical) - 2), digits)
    ip = F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))
    out = (F.when(kind == "email", F.concat(_veiled(local, draws), letters, F.lit("@"), new_domain))
           .when(kind == "ip", F.when(extra == 0, ip).otherwise(F.concat(ip, F.lit("."), digits)))
           .when(kind == "ssn", F.concat(F.lit("9"), _sub(like, 2, 8), digits))
           .when(kind == "card", F.concat(card, ((F.lit(10) - _check_sum(card, True)) % 10).cast("string")))
           .when(kind == "phone", phone)
           .when(kind == "secret", F.concat(like, letters)))
    for script, syllables in SYLLABLES.items():
        join = lambda first, n: F.array_join(F.transform(
            F.sequence(F.lit(0), n - 1), lambda i, first=first: _pick(draws[first + i], syllables)), "")
        out = out.when(kind == f"family-{script}", F.initcap(join(0, F.lit(3) + F.least(attempt, F.lit(8)).cast("int"))))
        for g in "mfn":
            base = _pick(draws[0], GIVEN[g, script])
            out = out.when(kind == f"given-{g}-{script}", F.when(attempt == 0, base).otherwise(
                F.concat(base, join(1, F.least(attempt, F.lit(8)).cast("int")))))
    return out


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(type, canonical, surrogate)`` for distinct ``(type, canonical)`` rows, without collisions."""
    spark = entities.sparkSession
    known = cut_lineage(entities.select("type", "canonical").distinct(), "entities")
    pending, settled = known.withColumn("attempt", F.lit(0)), []
    while True:
        # Few bytes, much work a row: not to be coalesced into a few tasks.
        spread = pending.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "type", "canonical")
        drawn = cut_lineage(_drawn(spread, key).select("type", "canonical", "attempt", _surrogate(
            F.col("type"), F.col("canonical"), F.col("attempt")).alias("surrogate")), "drawn")
        won = drawn.groupBy("type", "surrogate").agg(F.min("canonical").alias("canonical"))
        won = won.join(known.withColumnRenamed("canonical", "surrogate"), ["type", "surrogate"], "left_anti")
        for earlier in settled:
            won = won.join(earlier, ["type", "surrogate"], "left_anti")
        won = cut_lineage(won.select("type", "canonical", "surrogate"), "settled")
        settled.append(won)
        pending = drawn.join(won, ["type", "canonical"], "left_anti").select(
            "type", "canonical", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, settled)


def _in_format(kind: Column, surface: Column, canonical: Column, surrogate: Column) -> Column:
    """A surrogate written as the mention was: separators, letter case, what stands before it."""
    # A telephone number's country code stays; the entity is the number behind it.
    country = F.when(kind == "phone", F.regexp_extract(surface, _COUNTRY, 0)).otherwise("")
    frame = F.split(_sub(surface, F.length(country) + 1, F.length(surface)), r"\d")   # between the digits
    digits = F.concat(F.transform(F.sequence(F.lit(1), F.length(surrogate)),
                                  lambda i: _sub(surrogate, i, 1)), F.array(F.lit("")))
    number = F.array_join(F.flatten(F.zip_with(frame, digits, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    cased = (F.when(surface == F.upper(surface), F.upper(surrogate))
             .when(surface == F.lower(surface), F.lower(surrogate)).otherwise(surrogate))
    return (F.when(kind == "phone", F.concat(country, number))
            .when(kind.isin("card", "ssn"), number)
            .when(kind == "secret", F.concat(_sub(
                surface, F.lit(1), F.length(surface) - F.length(canonical)), surrogate))
            .when(kind == "email", F.concat(F.regexp_extract(surface, _LEAD, 0), F.when(
                surface == F.upper(surface), F.upper(surrogate)).otherwise(surrogate)))
            .when(kind == "ip", surrogate)
            .otherwise(cased))


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text",
                          count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; optionally the number of mentions."""
    text = F.col(text_col)
    hits = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), 0))
    has = F.coalesce(F.size(hits) > 0, F.lit(False))
    clean = docs.where(~has)
    # The row travels in one column: its other columns may have any name.
    found = cut_lineage(docs.where(has).select(
        F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"), hits.alias("hits"),
        F.split(text, PATTERN, -1).alias("parts")), "pii")
    atoms = _atoms(found.select("row", F.posexplode("hits").alias("pos", "hit")))
    typed = atoms.where("type IS NOT NULL")
    drawn = surrogates(typed, key)
    written = typed.join(drawn, ["type", "canonical"]).select(
        "row", "pos", "sub", _in_format(F.col("type"), F.col("surface"), F.col("canonical"),
                                        F.col("surrogate")).alias("new"), F.lit(1).alias("n"))
    kept = atoms.where("type IS NULL").select("row", "pos", "sub", F.col("surface").alias("new"), F.lit(0).alias("n"))
    # The words of a name mention follow the first with a space.
    spoken = written.unionByName(kept).withColumn("new", F.when(F.col("sub") > 0, F.concat(F.lit(" "), "new"))
                                                  .otherwise(F.col("new")))
    # What stands before mention ``pos`` is part ``pos`` of the text; so a text is all of these in order.
    between = found.select("row", F.posexplode("parts").alias("pos", "new")).select(
        "row", "pos", F.lit(-1).cast(spoken.schema["sub"].dataType).alias("sub"), "new", F.lit(0).alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "sub", "new")))
    rows = spoken.unionByName(between).groupBy("row").agg(
        F.array_join(ordered["new"], "").alias("rebuilt"),
        F.count_distinct(F.when(F.col("n") == 1, F.col("pos"))).alias("mentions"))
    changed = found.select("row", "doc").join(rows, "row").select(
        *[(F.col("rebuilt") if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns],
        *([F.col("mentions").alias(count_col)] if count_col else []))
    if count_col:
        clean = clean.withColumn(count_col, F.lit(0).cast("long"))
    return clean.unionByName(changed.select(clean.columns))
