"""Keyed surrogates for personal data in texts.

Entities are found by patterns.  Each is brought to a canonical form (lower-case
address, digits of a number, folded name), and a surrogate is drawn from a keyed
hash of type, canonical form and attempt, character by character, so it keeps
length, script, case and format.  The same entity gets the same surrogate wherever and
however it is written.

People are found behind an honorific.  A surname has one surrogate for all who
bear it, and a given name is drawn for the full name from lists of the same gender and
script, so ``Mr John Smith`` and ``Mr Smith`` stay together and ``Mr Jack Smith`` stays
apart.  An honorific without a gender takes that of the same name elsewhere in the corpus.
In the documents where a person is found, the parts of the name are replaced also
where they stand alone.

Attempt 0 settles nearly all entities.  Two entities with one surrogate, or a
surrogate that is an entity of the corpus, are collisions: the entity with the
smallest canonical form keeps the surrogate and the others go to the next
attempt, until none is left.  Names grow with the attempts, and from attempt LONGER on all
others but IPv4 addresses get more signs, so a free one is always found.  Only entities
beyond attempt 0 are kept in a table, which Spark joins as its size allows.

Rows are rewritten from their own texts; a text without entities is returned as
it is and a null text stays null.  A row is known by its doc_id and its text's hash, so
rows that repeat an id or have none are rewritten each by their own text.  A secret
without a letter or digit (``password: ****``) is a mask and stays.
Columns that have the name of a result column are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.llm.common import let, stored, without

# Attempts after which surrogates get longer, and after which there is an error: only when
# nearly all IPv4 addresses are taken.
LONGER = 12
ROUNDS = 100
RESULT = ("entities", "n_entities")

# Honorifics by gender; the name follows after a blank.
MALE = "Mr|Sir|Herr|Señor|Monsieur|Г-н|κ"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Señora|Madame|Г-жа|κα"
NEUTRAL = "Dr|Prof|Professor|Doktor|Д-р|Δρ"
_TITLES = "|".join(t for titles in (MALE, FEMALE, NEUTRAL) for t in (titles, titles.upper()))
# One or two words; neither is an honorific.
_NAME = rf"(?!(?:{_TITLES})\b)\p{{Lu}}[\p{{L}}'-]+(?: (?!(?:{_TITLES})\b)\p{{Lu}}[\p{{L}}'-]+)?"

# What is looked for, in order of precedence.  Patterns are in Java's syntax.
PATTERNS = {
    # Tried at the first sign of a word only and with bounded parts, so that a long word
    # without an @ costs no more than its length.
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,8}\.\p{L}{2,24}",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "secret": r"\b(?i:password|passwd|pwd|secret|token|api_?key)\s?[=:]\s?[\"']?(?=[^\s\"']*[\p{L}\p{N}])[^\s\"']{6,}",
    # At least ten digits, so that words in capitals are none; spaces as people set them.
    "iban": r"(?<![\p{L}\p{N}])(?=(?:[A-Z ]{0,12}\d){10})[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    # Eight groups, or fewer around a double colon; with a digit, so that names in code are none.
    "ip6": r"(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f:]{0,38}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){1,7}:|:(?::[0-9A-Fa-f]{1,4}){1,7})(?![\p{L}\p{N}:])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d.+])\d(?:[ -]?\d){12,18}(?![\d])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    # With a country code 8 to 15 digits in any groups; a bracket or groups of 3, 3 to 4 and 3
    # to 4; with a leading zero 8 to 15 digits in groups of 2 or more, but no date; ten digits.
    "phone": r"(?<![\d\p{L}])(?:\+\d(?:[ .()/-]{0,2}\d){7,14}"
    r"|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}"
    r"|(?<!\d[.,/-])(?!\d\d[./-]\d\d[./-]\d{2,4}(?!\d))(?=\d(?:[ ./-]?\d){7,14}(?!\d))0\d{1,4}(?:[ ./-]\d{2,8}){1,5}"
    r"|(?<!\d[.,])0[1-9]\d{7,9}|(?<!\d[.,])[2-9]\d{9}(?!\.\d))(?!\d)",
    "man": rf"\b(?:{MALE}|{MALE.upper()})\.? {_NAME}",
    "woman": rf"\b(?:{FEMALE}|{FEMALE.upper()})\.? {_NAME}",
    "person": rf"\b(?:{NEUTRAL}|{NEUTRAL.upper()})\.? {_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Country codes of one and two digits; all others have three.
COUNTRY = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
DIGITS = ("card", "ssn", "phone")
NAMES = ("man", "woman", "person")
# A word as it may be a part of a name.
NAME_WORD = r"\p{L}+(?:['’-]\p{Lu}\p{L}*)*"

# Letters of the scripts that are replaced by letters of the same script.
LETTERS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "[à-öø-ÿ]": "àáâãäåæçèéêëìíîïñòóôõöøùúûüý",
    "[À-ÖØ-Þ]": "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ",
    "[а-я]": "абвгдежзиклмнопрстуфхцчшыэюя",
    "[А-Я]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЫЭЮЯ",
    "[α-ω]": "αβγδεζηθικλμνξοπρστυφχψω",
    "[Α-Ω]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "[一-鿿]": "王李张刘陈杨黄赵吴周徐孙马朱胡林郭何高罗",
}
# Given names and surnames to draw from, by gender and script.
GIVEN = {
    ("man", "latin"): "Adam Bruno Carl David Emil Felix Georg Henry Ivan Jacob Karel Louis Martin Noel Oscar Peter Robert Simon Thomas Victor",
    ("woman", "latin"): "Anna Bella Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Tessa Vera",
    ("man", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Юрий",
    ("woman", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Ксения Лидия Мария Нина Ольга Полина Юлия",
    ("man", "greek"): "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Λουκάς Νίκος Πέτρος Σπύρος Χρήστος",
    ("woman", "greek"): "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία",
}
# Syllables of invented surnames, by script.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo",
    "cyrillic": "ба бе бо да де до ва ве га го ка ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то",
    "greek": "βα βε βο γα γο δα δε δο κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το",
}


def entities_in(text: Column) -> Column:
    """Matches in order of their places."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANY), 0)


def _first(value: Column, cases: dict, otherwise: Column) -> Column:
    """The case of the first pattern that is found in the value."""
    out = otherwise
    for pattern, result in reversed(cases.items()):
        out = F.when(value.rlike(pattern), result).otherwise(out)
    return out


def kind_of(raw: Column) -> Column:
    return _first(
        raw, {f"^(?:{p})$": F.lit(name) for name, p in PATTERNS.items()}, F.lit("card")
    )


def _lead(raw: Column, kind: Column) -> Column:
    """The part that stays as it is: a label with its sign, an honorific, a country code."""
    label = r"^(\w+\s?[=:]\s?[\"']?)"
    return (
        F.when(kind == "secret", F.regexp_extract(raw, label, 1))
        .when(kind == "key", F.substring(raw, 1, 4))
        .when(kind.isin(*NAMES), F.regexp_extract(raw, r"^(\S+ )", 1))
        .when(kind == "phone", F.regexp_extract(raw, rf"^(\+(?:{COUNTRY})[ .-]?|)", 1))
        .otherwise("")
    )


def canonical(raw: Column, kind: Column) -> Column:
    """One form for all ways to write an entity; labels and honorifics are not part of it."""
    rest = F.substr(raw, F.length(_lead(raw, kind)) + 1)
    return (
        F.when(kind.isin(*DIGITS), F.regexp_replace(raw, r"[^\d]", ""))
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind.isin("email", "ip6", *NAMES), F.lower(rest))
        .otherwise(rest)
    )


def _byte(stream: Column, i: Column | int) -> Column:
    """Byte i of a keyed stream of 64 bytes in hexadecimal digits."""
    at = (i if isinstance(i, Column) else F.lit(i)) % 64
    return F.conv(F.substr(stream, 2 * at + 1, F.lit(2)), 16, 10).cast("int")


def _pick(words: str, at: Column) -> Column:
    pool = words.split() if " " in words else list(words)
    return F.element_at(F.array(*[F.lit(w) for w in pool]), at % len(pool) + 1)


def _letters(value: Column, stream: Column) -> Column:
    """Digits become digits, letters letters of their script and case, the rest stays.

    Letters of scripts that are not listed are drawn from the 32 places around their own; those
    that have no letter there, or lie beyond the basic plane, become Latin ones."""
    hexadecimal = value.rlike("^[0-9a-f:]+$")

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        cases = {"[0-9]": _pick("0123456789", b)}
        cases["^[a-f]$"] = F.when(hexadecimal, _pick("abcdef", b)).otherwise(
            _pick(LETTERS["[a-z]"], b)
        )
        cases |= {pattern: _pick(pool, b) for pattern, pool in LETTERS.items()}
        other = _pick(LETTERS["[a-z]"], b)
        cases[r"^\p{L}$"] = F.when(F.ascii(c) > 0xFFFF, other).otherwise(
            let(_neighbour(c, b), lambda n: F.when(n.rlike(r"^\p{L}$"), n).otherwise(other))
        )
        return _first(c, cases, c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _neighbour(c: Column, b: Column) -> Column:
    """Another code point of the same 32 places of the basic plane."""
    place = F.floor(F.ascii(c) / 32) * 32 + b % 32
    return F.decode(F.unhex(F.lpad(F.hex(place), 4, "0")), "UTF-16BE")


def _luhn(digits: Column) -> Column:
    """Sum of the check rule over digits, the last one counted once."""
    places = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(
        i % 2 == 1, (2 * c.cast("int")) % 10 + F.floor(2 * c.cast("int") / 10).cast("int")
    ).otherwise(c.cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x)


def _numbers(value: Column, kind: Column, stream: Column) -> Column:
    """Digits for digits.  A card keeps its first digit and, if it had it, a valid check digit."""
    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        fixed = (kind == "card") & (i == 0)
        return F.when(fixed, c).when(c == "0", _pick("0123456789", b)).otherwise(_pick("123456789", b))

    drawn = F.array_join(F.transform(F.split(value, ""), one), "")
    body = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    # The digit that completes the sum to a multiple of ten.
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    valid = (kind == "card") & (_luhn(value) % 10 == 0)
    return F.when(valid, F.concat(body, check.cast("string"))).otherwise(drawn)


def _rest_of_97(value: Column) -> Column:
    """An account number without spaces, its first four signs moved to its end, modulo 97."""
    moved = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))
    return F.aggregate(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def _account(value: Column, stream: Column) -> Column:
    """Country and, if it had them, valid check digits stay; the rest is drawn."""
    country, body = F.substr(value, F.lit(1), F.lit(2)), _letters(F.substr(value, F.lit(5)), stream)
    check = F.lpad((98 - _rest_of_97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
    return F.concat(country, F.when(_rest_of_97(value) == 1, check).otherwise(F.substr(value, F.lit(3), F.lit(2))), body)


def _country_kept(raw: Column, kind: Column, drawn: Column) -> Column:
    code = F.regexp_replace(_lead(raw, kind), r"[^\d]", "")
    return F.concat(code, F.substr(drawn, F.length(code) + 1))


def _words(table: dict[str, str], script: Column) -> Column:
    """The word list of a script as an array."""
    cases = {k: F.array(*[F.lit(w) for w in words.split()]) for k, words in table.items()}
    out = cases["latin"]
    for name in ("greek", "cyrillic"):
        out = F.when(script == name, cases[name]).otherwise(out)
    return out


def _drawn_from(words: Column, at: Column) -> Column:
    return F.element_at(words, at % F.size(words) + 1)


def _script(value: Column) -> Column:
    return _first(value, {r"\p{IsCyrillic}": F.lit("cyrillic"), r"\p{IsGreek}": F.lit("greek")}, F.lit("latin"))


def _invented(value: Column, stream: Column, attempt: Column) -> Column:
    """A name of syllables; later attempts have longer ones, so there is always a free one."""
    places = F.sequence(F.lit(1), attempt + 4)
    return F.array_join(F.transform(places, lambda k: _drawn_from(_words(SYLLABLES, _script(value)), _byte(stream, k))), "")


def _full_name(value: Column, kind: Column, stream: Column, attempt: Column) -> Column:
    """Another given name of the same gender and script before the surname, which is a
    surrogate already; invented when the lists are used up."""
    script = _script(value)
    men, women = ({k[1]: w for k, w in GIVEN.items() if k[0] == g} for g in ("man", "woman"))
    is_man = (kind == "man") | ((kind == "person") & (_byte(stream, 9) % 2 == 0))
    listed = F.lower(_drawn_from(F.when(is_man, _words(men, script)).otherwise(_words(women, script)), _byte(stream, 0)))
    given = F.when(attempt < 4, listed).otherwise(_invented(value, stream, attempt - 3))
    return F.concat_ws(" ", given, F.substring_index(value, " ", -1))


def _address(value: Column, stream: Column) -> Column:
    octets = [F.lit(1) + (_byte(stream, k) * 256 + _byte(stream, k + 8)) % 254 for k in range(4)]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def surrogate(kind: Column, value: Column, attempt: Column, streams: tuple[Column, Column]) -> Column:
    """Canonical surrogate of a canonical entity, by its stream and that of its host."""
    stream, host_stream = streams
    is_mail = kind == "email"
    letters = _letters(F.when(is_mail, F.regexp_extract(value, "^([^@]*)@", 1)).otherwise(value), stream)
    host = _letters(F.regexp_extract(value, r"@(.*)\.", 1), host_stream)
    return (
        F.when(is_mail, F.concat(letters, F.lit("@"), host, F.regexp_extract(value, r"(\.[^.]*)$", 1)))
        .when(kind == "ip", _address(value, stream))
        .when(kind == "iban", _account(value, stream))
        .when(kind.isin(*DIGITS), _numbers(value, kind, stream))
        .when(kind.isin(*NAMES), _full_name(value, kind, stream, attempt))
        .when(kind == "surname", _invented(value, stream, attempt))
        .otherwise(letters)
    )


def with_surrogate(frame: DataFrame, key: str) -> DataFrame:
    """Adds ``drawn`` to a frame with kind, canon, attempt and raw.

    The keyed streams are columns of their own, made once per entity.  The host
    of an address has its own, so addresses of one host stay together.
    """
    kind, value, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    host = F.regexp_extract(value, r"@(.*)\.", 1)
    streams = {
        "_stream": F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), 512),
        "_host": F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), host), 512),
    }
    drawn = frame.withColumns(streams)
    drawn = drawn.withColumn("_drawn", surrogate(kind, value, attempt, (F.col("_stream"), F.col("_host"))))
    kept = F.when(kind == "phone", _country_kept(F.col("raw"), kind, F.col("_drawn"))).otherwise(F.col("_drawn"))
    # More signs of the kind, one more with each attempt.
    places = F.sequence(F.lit(0), attempt - LONGER)
    signs = F.when(kind.isin("email", "key", "secret"), F.lit("abcdefghij")).otherwise(F.lit("0123456789"))
    more = F.array_join(F.transform(places, lambda k: F.substr(signs, _byte(F.col("_stream"), k + 20) % 10 + 1, F.lit(1))), "")
    long = F.when(kind == "email", F.concat(more, kept)).otherwise(F.concat(kept, more))
    kept = F.when((attempt >= LONGER) & ~kind.isin("ip", "surname", *NAMES), long).otherwise(kept)
    return drawn.withColumn("drawn", kept).drop("_stream", "_host", "_drawn")


def rendered(raw: Column, kind: Column, drawn: Column) -> Column:
    """The surrogate in the way in which the entity is written here."""
    lead = _lead(raw, kind)
    digits = F.aggregate(
        F.filter(F.split(raw, ""), lambda c: c != ""),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("n")),
        lambda a, c: F.when(
            c.rlike("[0-9]") | ((kind == "iban") & (c != " ")),
            F.struct(F.concat(a["out"], F.substr(drawn, a["n"] + 1, F.lit(1))).alias("out"), (a["n"] + 1).alias("n")),
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["n"].alias("n"))),
        # What a longer surrogate has beyond the places.
        lambda a: F.concat(a["out"], F.substr(drawn, a["n"] + 1)),
    )
    cased = F.array_join(
        F.transform(
            F.split(drawn, ""),
            lambda c, i: F.when(F.substr(raw, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c),
        ),
        "",
    )
    return (
        F.when(kind.isin("iban", *DIGITS), digits)
        .when(kind.isin("email", "ip6"), cased)
        .when(kind.isin(*NAMES), F.concat(lead, _said(raw, drawn)))
        .otherwise(F.concat(lead, drawn))
    )


def _said(raw: Column, drawn: Column) -> Column:
    """A name in capitals if the mention is, else with capital initials."""
    return F.when(raw == F.upper(raw), F.upper(drawn)).otherwise(F.initcap(drawn))


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, raw, kind, canon): each way to write an entity, once per row of docs."""
    raw = docs.select("doc_id", F.xxhash64("text").alias("_h"), F.explode(F.array_distinct(entities_in(F.col("text")))).alias("raw"))
    kinds = raw.withColumn("kind", kind_of(F.col("raw")))
    return kinds.withColumn("canon", canonical(F.col("raw"), F.col("kind")))


def later_attempts(found: DataFrame, key: str) -> DataFrame:
    """(kind, canon, attempt) of the entities that attempt 0 does not settle."""
    entities = stored(
        found.groupBy("kind", "canon").agg(F.min("raw").alias("raw")), "entities"
    )
    settled: list[DataFrame] = []
    pending, attempt = entities, 0
    while True:
        # Written, as it is used twice and its plan is large.
        tried = stored(with_surrogate(pending.withColumn("attempt", F.lit(attempt)), key), "tried")
        # An accepted surrogate and an entity of the corpus both bar the way.
        barred = [entities.select("kind", F.col("canon").alias("drawn")), *(s.select("kind", "drawn") for s in settled)]
        free = tried.join(reduce(DataFrame.union, barred).distinct(), ["kind", "drawn"], "left_semi")
        taken = free.select("kind", "canon", F.lit(True).alias("taken"))
        order = W.partitionBy("kind", "drawn").orderBy("taken", "canon")
        judged = tried.join(taken, ["kind", "canon"], "left").fillna(False, ["taken"]).withColumn(
            "good", ~F.col("taken") & (F.row_number().over(order) == 1)
        )
        judged = stored(judged, "attempt")
        settled.append(judged.where("good").select("kind", "canon", "attempt", "drawn"))
        pending = judged.where("NOT good").select("kind", "canon", "raw")
        attempt += 1
        if pending.isEmpty():
            break
        if attempt == ROUNDS:
            raise RuntimeError(f"entities without a free surrogate after {ROUNDS} attempts")
    return reduce(DataFrame.union, settled).where("attempt > 0").select("kind", "canon", "attempt")


def _with_gender(found: DataFrame) -> DataFrame:
    """Mentions whose honorific tells no gender take that of the same name elsewhere."""
    told = found.where(F.col("kind").isin("man", "woman")).groupBy("canon").agg(F.min("kind").alias("_told"))
    neutral = found.where("kind = 'person'").join(told, "canon", "left")
    return found.where("kind <> 'person'").unionByName(
        neutral.withColumn("kind", F.coalesce("_told", "kind")).drop("_told")
    )


def _settled(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, drawn) of all different entities, collisions settled."""
    once = stored(entities.groupBy("kind", "canon").agg(F.min("raw").alias("raw")), "once")
    later = later_attempts(once, key)
    tried = once.join(later, ["kind", "canon"], "left").fillna(0, ["attempt"])
    return with_surrogate(tried, key).select("kind", "canon", "drawn")


def person_surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, canon, drawn) of the people among the mentions.

    Surnames first; then full names, in which the surname is a surrogate already.
    """
    people = found.where(F.col("kind").isin(*NAMES)).select("kind", "canon").distinct()
    surname = F.substring_index("canon", " ", -1)
    named = stored(people.withColumn("surname", surname), "people")
    alone = named.select(F.lit("surname").alias("kind"), F.col("surname").alias("canon"), F.col("surname").alias("raw"))
    surnames = _settled(alone, key).select(F.col("canon").alias("surname"), F.col("drawn").alias("new"))
    known = stored(named.join(surnames, "surname"), "surnames")
    full = known.where("instr(canon, ' ') > 0").withColumn(
        "half", F.concat_ws(" ", F.substring_index("canon", " ", 1), "new")
    )
    drawn = _settled(full.select("kind", F.col("half").alias("canon"), F.col("half").alias("raw")), key)
    whole = full.join(drawn.withColumnRenamed("canon", "half"), ["kind", "half"]).select("kind", "canon", "drawn")
    return whole.unionByName(known.where("instr(canon, ' ') = 0").select("kind", "canon", F.col("new").alias("drawn")))


def _parts(raw: Column, kind: Column, drawn: Column) -> Column:
    """(word, replacement) of a person's name parts, as the mention writes them and, of one in
    capitals, with capital initials too."""
    name = F.substr(raw, F.length(_lead(raw, kind)) + 1)
    old, new = F.split(name, " "), F.split(_said(raw, drawn), " ")
    # A name of one word is a surname.
    pairs = F.transform(old, lambda w, i: F.struct(w.alias("word"), F.get(new, i).alias("new")))
    calm = F.transform(pairs, lambda p: F.struct(F.initcap(p["word"]).alias("word"), F.initcap(p["new"]).alias("new")))
    return F.when(kind.isin(*NAMES), F.concat(pairs, calm)).otherwise(F.array().cast("array<struct<word:string,new:string>>"))


def _first_of_each_word(parts: Column) -> Column:
    """The first of the sorted parts for each word: people of one document may share a given name."""
    return let(
        F.array_sort(F.array_distinct(parts)),
        lambda p: F.filter(p, lambda e, i: (i == 0) | (e["word"] != F.coalesce(F.get(p, i - 1)["word"], F.lit("")))),
    )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The documents with surrogates in their texts, ``entities`` (kind, raw,
    replacement for each way of writing; ``part`` for parts of names that stand alone) and
    n_entities, the places replaced."""
    found = stored(_with_gender(stored(mentions(docs), "mentions")), "entities")
    others = found.where(~F.col("kind").isin(*NAMES))
    later = later_attempts(others, key)
    drawn = with_surrogate(others.join(later, ["kind", "canon"], "left").fillna(0, ["attempt"]), key)
    columns = ["doc_id", "_h", "kind", "raw", "drawn"]
    people = found.where(F.col("kind").isin(*NAMES)).join(person_surrogates(found, key), ["kind", "canon"])
    new = drawn.select(*columns).unionByName(people.select(*columns))
    entity = F.struct("kind", "raw", rendered(F.col("raw"), F.col("kind"), F.col("drawn")).alias("replacement"))
    per_row = (
        new.select("doc_id", "_h", entity.alias("entity"), _parts(F.col("raw"), F.col("kind"), F.col("drawn")).alias("parts"))
        .groupBy("doc_id", "_h")
        .agg(
            F.array_sort(F.collect_set("entity")).alias("entities"),
            _first_of_each_word(F.flatten(F.collect_list("parts"))).alias("__parts"),
        )
    )
    keyed = without(docs, RESULT).withColumn("__h", F.xxhash64("text"))
    own_row = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.__h") == F.col("p._h"))
    table = F.map_from_entries(F.transform("entities", lambda e: F.struct(e["raw"], e["replacement"])))
    words = F.map_from_entries("__parts")
    filled = F.transform(entities_in(F.col("text")), lambda e: F.element_at("__table", e))
    # The text between entities alternates with their replacements; where people are named
    # it is taken apart into words and the rest.
    gaps = F.split("text", ANY)
    pieces = F.when(
        F.size("__parts") > 0,
        F.transform(gaps, lambda g: F.regexp_extract_all(g, F.lit(rf"{NAME_WORD}|\P{{L}}+"), F.lit(0))),
    ).otherwise(F.transform(gaps, lambda g: F.array(g)))
    text = F.array_join(
        F.flatten(
            F.transform(
                "__pieces",
                lambda piece, i: F.concat(
                    F.transform(piece, lambda w: F.coalesce(F.element_at("__words", w), w)),
                    F.array(F.coalesce(F.get("__filled", i), F.lit(""))),
                ),
            )
        ),
        "",
    )
    alone = F.filter(F.flatten("__pieces"), lambda w: F.map_contains_key("__words", w))
    named = F.transform(
        F.array_distinct(F.col("__alone")),
        lambda w: F.struct(F.lit("part").alias("kind"), w.alias("raw"), F.element_at("__words", w).alias("replacement")),
    )
    has = F.col("entities").isNotNull()
    return (
        keyed.alias("d")
        .join(per_row.alias("p"), own_row, "left")
        .select("d.*", "entities", "__parts", F.when(has, table).alias("__table"), F.when(has, words).alias("__words"))
        .drop("__h")
        .withColumn("__filled", F.when(has, filled))
        .withColumn("__pieces", F.when(has, pieces))
        .withColumn("__alone", F.when(has, alone))
        .withColumn("text", F.when(F.size("__filled") > 0, text).otherwise(F.col("text")))
        .withColumn("n_entities", F.coalesce(F.size("__filled") + F.size("__alone"), F.lit(0)))
        .withColumn("entities", F.concat("entities", F.array_sort(named)))
        .drop("__table", "__filled", "__pieces", "__words", "__parts", "__alone")
    )
