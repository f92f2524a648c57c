"""Surrogates for personal data (DataFrame functions only).

Entities (mail addresses, secrets, IP addresses, telephone, card and social security numbers, names
after a title) are found by one pattern. An entity's canonical form keys a SHA-256 stream that draws
its surrogate: digits for digits, letters for letters of the same script, hex for hex, an octet in the same
range of digits, a name of the title's gender and the name's script; the country code, the top-level
domain, the prefix of a secret and the remainder of a card's check sum stay. Each occurrence gets the surrogate of its canonical form in
its own punctuation and case, so that mentions of one entity still agree everywhere.

A person is first names (of the title's gender; titles as Dr tell none) and a last name, which have a surrogate each: `Mr John Smith` and `Mr Smith` keep
one last name, two people who share it still differ by their first names. A name is all words with a capital after a title, with hyphens,
apostrophes and particles (`van`, `de`), which stay. In the document that has `Mr John Smith`,
`John Smith` or `JOHN SMITH` without a title is replaced too. A last name alone and names that no title ever introduces are left: nothing
tells them from other words.

Distinctness: the table of distinct entities is checked for surrogates that two entities share or
that are themselves entities of the corpus; the later of them are drawn again with the next attempt
until none is left. Each attempt adds a syllable to a name; from attempt SAME_SHAPE on it adds a character or digit to the others and octets take any
value (from twice that on an address gets one of the longer kind), so that the space outgrows every corpus. Only redrawn entities need a lookup, joined back to the documents that hold
them; all others are computed in place, so that a common entity never gathers its rows in one task.

The key is an argument or the setting KEY_SETTING of the session; without either nothing is replaced but an error raised.

Defined cases: a null text stays null and has no entity; an empty table gives an empty table; rows
that repeat a doc_id are rewritten each; rows without a doc_id are told apart by their text; other columns pass through, `n_entities` is replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import materialize, table

KEY_SETTING = "spark.framewright.surrogate.key"
QUERY_KEY = "the queries on test tables"  # fixed, so that their results can be compared
SAME_SHAPE = 8
WORDISH = r"\p{L}\p{M}\p{N}._%+\-"
MAIL = rf"(?<![{WORDISH}])[{WORDISH}]++@[\p{{L}}\p{{N}}\-]+(?:\.[\p{{L}}\p{{N}}\-]+)+"
#: How tokens of common services start.
STARTS = "AKIA|ghp_|github_pat_|glpat-|xox[abprs]-|AIza|sk-"
SECRET = (
    rf"(?<![\p{{L}}\p{{N}}_\-])(?:[0-9a-fA-F]{{32,}}+(?![\p{{L}}\p{{N}}])|(?:{STARTS})[A-Za-z0-9_\-]{{16,}}+|eyJ[A-Za-z0-9_\-]{{5,}}+\.[A-Za-z0-9_\-]{{5,}}+\.[A-Za-z0-9_\-]{{5,}}+)"
)
#: Account numbers: a country, two digits, groups of four with at least one digit each.
ACCOUNT = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?(?=[A-Z]{0,3}\d)[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
GROUP = r"[0-9a-fA-F]{1,4}"
PREFIX = f"^(?:{STARTS}|eyJ)(?:(?:proj|live|test)-)?"
#: Eight groups, or fewer around a `::` with one of three or four digits, so that slices as 1::2 stay.
SIX = (
    rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9a-fA-F:]*\d)(?:(?:{GROUP}:){{7}}{GROUP}|(?=[0-9a-fA-F:]*(?<![0-9a-fA-F])[0-9a-fA-F]{{3,4}}(?![0-9a-fA-F]))(?!(?::*{GROUP}(?![0-9a-fA-F])){{8}})"
    rf"(?:{GROUP}(?::{GROUP}){{0,6}})?::(?:{GROUP}(?::{GROUP}){{0,6}})?)(?![\p{{L}}\p{{N}}:]|\.\d)"
)
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
#: With a plus sign up to 15 digits, compact or spaced; national numbers in their usual groups, unless they start a card's number.
PHONE = (
    r"(?<![\p{L}\p{N}])(?:\+\d{10,15}|\+\d(?:[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d){6,14}|\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}"
    r"|(?!\d(?:[ \-]?\d){12,18}(?!\d))(?:\d{3}[ .\-]\d{3}[ .\-]\d{4}|0\d(?:[ .\-]\d{2}){4}|\(0\d{1,4}\) ?\d{3,4}[ \-]?\d{3,4}|0\d{2,4}[ \-]\d{3,4}[ \-]?\d{3,4}))(?!\d)"
)
SOCIAL = r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"
CARD = r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)"
#: Titles by gender and the names that take the place of others.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа"]
NAMES = {
    ("m", "latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Mateo", "Nils", "Oscar", "Paul", "Simon"],
    ("f", "latin"): ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irma", "Julia", "Laura", "Maria", "Nora", "Olga", "Paula", "Vera"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Семён", "Юрий"],
    ("f", "cyrillic"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Кира", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Юлия"],
}
SURNAME_ENDS = {"latin": ["berg", "dale", "feld", "holm", "land", "mann", "mont", "stad"], "cyrillic": ["енко", "ич", "ко", "ский", "ук", "цев", "чук", "як"]}
#: Titles that tell no gender, and words inside a name that are no names.
NEUTRAL = ["Dr", "Prof", "Professor", "Доктор", "Профессор"]
PARTICLES = ["af", "al", "av", "bin", "d", "da", "das", "de", "del", "della", "den", "der", "di", "dos", "du", "el", "ibn", "la", "le", "ten", "ter", "van", "von", "zu", "zur"]
FEMALE += [t.upper() for t in FEMALE]
NEUTRAL += [t.upper() for t in NEUTRAL]
TITLES = "|".join([*MALE, *[t.upper() for t in MALE], *FEMALE, *NEUTRAL])
GAP = r"[ \t\u00A0]{1,3}"
NAME_WORD = r"\p{Lu}[\p{L}\p{M}]*(?:['\u2019\-]\p{L}[\p{L}\p{M}]*)*+"
PARTICLE = rf"(?:{'|'.join(PARTICLES)})"
PART = rf"(?:\p{{Lu}}\.(?={GAP}(?:{PARTICLE}{GAP})*+\p{{Lu}})|{NAME_WORD})"  # an initial or a word
#: Possessive, so that no match ends inside a name; a single letter is no name, unless others follow it.
NAME = rf"(?<!\p{{L}})(?:{TITLES})\.?{GAP}(?!\p{{Lu}}(?![\p{{L}}\p{{M}}'\u2019\-]|\.?{GAP}\p{{Lu}}))(?:{PARTICLE}{GAP})*+{PART}(?:{GAP}(?:{PARTICLE}{GAP})*+{PART})*+(?!\p{{L}})"
TITLE = rf"^(?:{TITLES})\.?{GAP}"
ENTITY = "|".join([MAIL, SECRET, SIX, ADDRESS, ACCOUNT, PHONE, SOCIAL, CARD, NAME])
#: What every entity has; the look-ahead spares most characters the alternatives.
LIKELY = rf"(?=[0-9@Agsxe{''.join(sorted({t[0] for t in TITLES.split('|')}))}])(?:[0-9@]|{STARTS}|eyJ|{TITLES})"
#: The letters that stand for letters.
LATIN, CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщэюя"


def _let(value: Column, use) -> Column:
    """use(value) with value computed once: an expression inside a lambda is otherwise computed anew for each element."""
    return F.transform(F.array(value), use)[0]


def kind_of(found: Column) -> Column:
    whole = lambda p: found.rlike(f"^(?:{p})$")
    return (
        F.when(found.contains("@"), "mail").when(whole(ADDRESS) | whole(SIX), "ip").when(whole(SOCIAL), "social").when(whole(PHONE), "phone")
        .when(whole(ACCOUNT), "account").when(whole(CARD), "card").when(whole(SECRET), "secret").otherwise("name")
    )


def canonical(kind: Column, found: Column) -> Column:
    """What two mentions of one entity have in common."""
    of = lambda titles: found.rlike(rf"^(?:{'|'.join(titles)})(?!\p{{L}})")
    words = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(found, TITLE, "")), rf"\.?{GAP}", " "), "\u2019", "'")
    name = F.concat(F.when(of(FEMALE), "f ").when(of(NEUTRAL), "n ").otherwise("m "), words)
    return (
        F.when(kind == "mail", F.lower(found)).when(kind.isin("phone", "card", "social"), F.regexp_replace(found, r"\D", ""))
        .when(kind == "account", F.regexp_replace(found, " ", "")).when(kind == "name", name).when((kind == "ip") & found.contains(":"), _eight_groups(found)).otherwise(found)
    )


def _eight_groups(found: Column) -> Column:
    """An IPv6 address with all its groups, in lower case and without leading zeros."""
    side = lambda i: F.filter(F.split(F.coalesce(F.get(F.split(F.lower(found), "::", -1), F.lit(i)), F.lit("")), ":"), lambda g: g != "")
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(side(0)) - F.size(side(1)), F.lit(0)))
    return F.array_join(F.transform(F.concat(side(0), zeros, side(1)), lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def _extra(kind: Column, attempt: Column) -> Column:
    """The characters, digits or syllables that a surrogate has more than its entity."""
    return F.when(kind.isin("first", "last"), attempt).otherwise(F.greatest(attempt - (SAME_SHAPE - 1), F.lit(0)))


def parts_of(kind: Column, canon: Column) -> Column:
    """The entities that get a surrogate of their own, as (kind, canon): a person's names, or the entity itself."""
    part = lambda k, c: F.struct((F.lit(k) if isinstance(k, str) else k).alias("kind"), c.alias("canon"))
    words = F.split(canon, " ")
    last = F.array(part("last", F.element_at(words, -1)))
    given = F.filter(F.slice(words, 2, F.size(words) - 2), lambda w: ~w.isin(PARTICLES))
    first = F.transform(given, lambda w: part("first", F.concat_ws(" ", words[0], w)))
    return F.when((kind == "name") & (F.size(words) > 2), F.concat(last, first)).when(kind == "name", last).otherwise(F.array(part(kind, canon)))


def _draws(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """A keyed number 0..65535 for each position of canon and two for each extra one, as an array."""
    many = F.greatest(F.length(canon), F.lit(6)) + 2 * _extra(kind, attempt)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(many / 16).cast("int")), lambda b: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), b.cast("string"), F.lit(key)), 256))
    return _let(F.array_join(blocks, ""), lambda stream: F.transform(F.sequence(F.lit(0), many), lambda i: F.conv(F.substring(stream, i * 4 + 1, F.lit(4)), 16, 10).cast("int")))


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _pick(letters: str, draw: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(draw, F.lit(len(letters))) + 1, F.lit(1))


def _like(char: Column, draw: Column) -> Column:
    """A character of the same class and script."""
    return (
        F.when(char.rlike("[0-9]"), F.pmod(draw, F.lit(10)).cast("string"))
        .when(char.rlike(r"\p{IsCyrillic}"), F.when(F.lower(char) == char, _pick(CYRILLIC, draw)).otherwise(F.upper(_pick(CYRILLIC, draw))))
        .when(char.rlike(r"\p{Lu}"), F.upper(_pick(LATIN, draw))).when(char.rlike(r"\p{L}"), _pick(LATIN, draw)).otherwise(char)
    )


def _check_sum(digits: Column) -> Column:
    """The card check sum of a string of digits, modulo 10."""
    doubled = lambda d: F.when(d > 9, d - 9).otherwise(d)
    values = lambda n: F.transform(_chars(digits), lambda c, i: _let(c.cast("int") * F.when(F.pmod(n - i, F.lit(2)) == 0, 2).otherwise(1), doubled))
    return F.pmod(F.aggregate(_let(F.length(digits), values), F.lit(0), lambda a, x: a + x), F.lit(10))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical entity, itself in canonical form."""
    extra = _extra(kind, attempt)
    grown = F.when(kind == "mail", F.concat(F.repeat(F.lit("a"), extra), canon)).otherwise(F.concat(canon, F.repeat(F.when(kind == "secret", "a").otherwise("0"), extra)))

    def drawn(d: Column) -> Column:
        same = lambda text, shift=0: F.array_join(F.transform(_chars(text), lambda c, i: _like(c, F.element_at(d, i + 1 + shift))), "")
        top = F.regexp_extract(canon, r"\.[^.@]*$", 0)
        mail = F.concat(same(F.substring(grown, F.lit(1), F.length(grown) - F.length(top))), top)
        octet = lambda o, i: _let(F.element_at(d, i + 1), lambda x: F.when(attempt >= SAME_SHAPE, F.pmod(x, F.lit(255)) + 1).when(F.length(o) == 1, F.pmod(x, F.lit(9)) + 1).when(F.length(o) == 2, F.pmod(x, F.lit(90)) + 10).otherwise(F.pmod(x, F.lit(155)) + 100).cast("string"))
        part = lambda g, i: _let(F.element_at(d, i + 1), lambda x: F.lower(F.hex(F.when(attempt >= SAME_SHAPE, F.pmod(x, F.lit(65535)) + 1).when(g == "0", 0).when(F.length(g) == 1, F.pmod(x, F.lit(15)) + 1).when(F.length(g) == 2, F.pmod(x, F.lit(240)) + 16).when(F.length(g) == 3, F.pmod(x, F.lit(3840)) + 256).otherwise(F.pmod(x, F.lit(61440)) + 4096))))
        six = F.array_join(F.transform(F.when(canon.contains(":"), F.split(canon, ":")).otherwise(F.array_repeat(F.lit("1"), 8)), part), ":")
        ip = F.when(canon.contains(":") | (attempt >= 2 * SAME_SHAPE), six).otherwise(F.array_join(F.transform(F.split(canon, r"\."), octet), "."))
        code = F.greatest(F.length(canon) - 10, F.lit(0))
        first = F.when((code == 0) & canon.startswith("0"), "0").when(code < F.length(canon), (F.pmod(F.element_at(d, code + 1), F.lit(8)) + 2).cast("string")).otherwise("")
        phone = F.concat(F.substring(canon, F.lit(1), code), first, F.substring(same(grown), code + 2, F.length(grown)))
        card = _let(F.substring(same(grown), F.lit(1), F.length(grown) - 1), lambda body: F.concat(body, F.pmod(_check_sum(canon) - _check_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")))
        hexed = F.array_join(F.transform(_chars(grown), lambda c, i: _pick("0123456789abcdef", F.element_at(d, i + 1))), "")
        hexed = F.when(canon.rlike("[A-F]") & ~canon.rlike("[a-f]"), F.upper(hexed)).otherwise(hexed)
        start = F.regexp_extract(canon, PREFIX, 0)
        account = F.concat(F.substring(canon, 1, 2), F.substring(same(grown), F.lit(3), F.length(grown)))
        secret = F.when(canon.rlike("^[0-9a-fA-F]+$"), hexed).otherwise(F.concat(start, F.substring(same(grown), F.length(start) + 1, F.length(grown))))
        return (
            F.when(kind == "mail", mail).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card).when(kind == "secret", secret).when(kind == "account", account)
            .when(kind == "first", _first_name(canon, d, extra)).when(kind == "last", _last_name(canon, d, extra)).otherwise(same(grown))
        )

    return _let(_draws(kind, canon, attempt, key), drawn)


def _at(values: list[str], d: Column, n) -> Column:
    return F.element_at(F.array(*[F.lit(v.lower()) for v in values]), F.pmod(F.element_at(d, n), F.lit(len(values))) + 1)


def _syllables(script: str, d: Column, extra: Column) -> Column:
    letters, vowels = (CYRILLIC, list("аеиоу")) if script == "cyrillic" else (LATIN, list("aeiou"))
    each = F.when(extra > 0, F.sequence(F.lit(1), extra)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(each, lambda i: F.concat(_pick(letters, F.element_at(d, 2 * i + 5)), _at(vowels, d, 2 * i + 4))), "")


def _of_script(canon: Column, make) -> Column:
    return F.when(canon.rlike(r"\p{IsCyrillic}"), make("cyrillic")).otherwise(make("latin"))


def _first_name(canon: Column, d: Column, extra: Column) -> Column:
    """`f first`, `m first` or `n first` in lower case: a listed name of the gender and script, after syllables where that is not enough."""
    name = lambda script: F.concat(_syllables(script, d, extra), F.when(canon.startswith("f "), _at(NAMES["f", script], d, 1)).when(canon.startswith("n "), _at(NAMES["f", script] + NAMES["m", script], d, 1)).otherwise(_at(NAMES["m", script], d, 1)))
    return F.concat(F.substring(canon, 1, 2), _of_script(canon, name))


def _last_name(canon: Column, d: Column, extra: Column) -> Column:
    def name(script: str) -> Column:
        letters, vowels = (CYRILLIC, list("аеиоу")) if script == "cyrillic" else (LATIN, list("aeiou"))
        return F.concat(_pick(letters, F.element_at(d, 2)), _at(vowels, d, 3), _pick(letters, F.element_at(d, 4)), _syllables(script, d, extra), _at(SURNAME_ENDS[script], d, 5))

    return _of_script(canon, name)


def rendered(kind: Column, found: Column, made: Column) -> Column:
    """The surrogate in the punctuation and case of an occurrence."""
    digits = F.array_join(F.transform(_chars(found), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(made, F.length(F.regexp_replace(F.substring(found, F.lit(1), i + 1), r"\D", "")), F.lit(1))).otherwise(c)), "")
    mail = F.array_join(F.transform(_chars(found), lambda c, i: F.when(c.rlike(r"\p{Lu}"), F.upper(F.substring(made, i + 1, F.lit(1)))).otherwise(F.substring(made, i + 1, F.lit(1)))), "")
    digits = F.concat(digits, F.substring(made, F.length(F.regexp_replace(found, r"\D", "")) + 1, F.length(made)))
    mail = F.concat(mail, F.substring(made, F.length(found) + 1, F.length(made)))
    name = F.concat(F.regexp_extract(found, TITLE, 0), spoken(F.regexp_replace(found, TITLE, ""), F.split(F.substring(made, F.lit(3), F.length(made)), " ")))
    gaps = lambda i: F.length(F.regexp_replace(F.substring(found, F.lit(1), i + 1), " ", ""))
    account = F.array_join(F.transform(_chars(found), lambda c, i: F.when(c == " ", c).otherwise(F.substring(made, gaps(i), F.lit(1)))), "")
    account = F.concat(account, F.substring(made, F.length(F.regexp_replace(found, " ", "")) + 1, F.length(made)))
    short = F.regexp_replace(made, r"^((?:[0-9a-f]+:)*?)0(?::0)+(?=:|$)", "$1")
    short = F.concat(F.when(short.startswith(":"), ":").otherwise(""), short, F.when(short.endswith(":"), ":").otherwise(""))
    six = F.when(found.contains("::"), short).otherwise(made)
    six = F.when(found.rlike("[A-F]") & ~found.rlike("[a-f]"), F.upper(six)).otherwise(six)
    return (
        F.when(kind.isin("phone", "card", "social"), digits).when(kind == "mail", mail).when(kind == "name", name).when(kind == "account", account)
        .when((kind == "ip") & found.contains(":"), six).otherwise(made)
    )


def spoken(old: Column, new: Column) -> Column:
    """The words of a name, as an array, in the case of the old ones: small words as they were, words in capitals in capitals."""
    word = lambda w, n: F.when(w.rlike(r"^\p{Ll}"), w).when(w.rlike(r"^\p{Lu}[\p{Lu}\p{M}'\u2019\-]+$"), F.upper(n)).otherwise(F.initcap(n))
    return F.array_join(F.zip_with(F.split(old, rf"\.?{GAP}"), new, word), " ")


def entities_of(text: Column) -> Column:
    """The entities of a text in order, as structs (kind, canon, found)."""
    found = F.when(text.rlike(LIKELY), F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(1)))

    def whole(f: Column) -> Column:
        return _let(kind_of(f), lambda k: F.struct(k.alias("kind"), canonical(k, f).alias("canon"), f.alias("found")))

    return F.transform(found, whole)


def redrawn(distinct: DataFrame, key: str) -> DataFrame:
    """distinct: kind, canon. Returns kind, canon, made of the entities whose first surrogate clashes; the table may be empty."""
    held = materialize(distinct.select("kind", "canon", F.lit(0).alias("attempt"), surrogate(F.col("kind"), F.col("canon"), F.lit(0), key).alias("made")), "pii-made")
    while True:  # ends, as each attempt from SAME_SHAPE on has many times the surrogates of the one before
        first = held.groupBy("kind", "made").agg(F.min(F.struct("attempt", "canon")).alias("first"), F.count(F.lit(1)).alias("n"))
        shared = held.join(first.where(F.col("n") > 1), ["kind", "made"]).where(F.col("canon") != F.col("first.canon")).select("kind", "canon")
        taken = held.join(held.select("kind", F.col("canon").alias("made")), ["kind", "made"], "left_semi").select("kind", "canon")
        bad = materialize(shared.unionByName(taken).distinct().withColumn("bad", F.lit(True)), "pii-clashes")
        if bad.isEmpty():
            return held.where(F.col("attempt") > 0).select("kind", "canon", "made")
        step = held.join(bad, ["kind", "canon"], "left").withColumn("attempt", F.col("attempt") + F.when(F.col("bad"), 1).otherwise(0))
        held = materialize(step.select("kind", "canon", "attempt", F.when(F.col("bad"), surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)).otherwise(F.col("made")).alias("made")), "pii-made")


def surrogate_key(spark: SparkSession, key: str | None = None) -> str:
    key = key or spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"surrogates need a key: pass one or set {KEY_SETTING}")
    return key


def replace_entities(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with the entities of text replaced, and n_entities."""
    key = surrogate_key(docs.sparkSession, key)
    text = F.col("text")
    columns = [c for c in docs.columns if c != "n_entities"]
    row = F.xxhash64("doc_id", "text")
    own = f"pii_{uuid.uuid4().hex}"  # no column of the table has this name
    mentions = docs.select(row.alias("m_row"), F.explode(entities_of(text)).alias("e")).select("m_row", F.explode(parts_of(F.col("e.kind"), F.col("e.canon"))).alias("p")).select("m_row", "p.*")
    mentions = materialize(mentions.distinct(), "pii-mentions")
    again = materialize(redrawn(mentions.select("kind", "canon").distinct(), key), "pii-redrawn")
    held = docs.select(*columns)
    special = F.lit(None).cast("map<string,string>")
    if not again.isEmpty():
        looked = mentions.join(again, ["kind", "canon"]).groupBy("m_row").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "canon").alias("k"), F.col("made").alias("v")))).alias(f"{own}_special")).withColumnRenamed("m_row", f"{own}_row")
        held = held.join(looked, row == F.col(f"{own}_row"), "left")
        special = F.col(f"{own}_special")

    def made(kind: Column, canon: Column) -> Column:
        return F.coalesce(F.try_element_at(special, F.concat_ws("\x1f", kind, canon)), surrogate(kind, canon, F.lit(0), key))

    def person(canon: Column) -> Column:
        words = F.split(canon, " ")
        first = lambda w: F.when(w.isin(PARTICLES), w).otherwise(F.substring(made(F.lit("first"), F.concat_ws(" ", words[0], w)), 3, 1 << 20))
        given = F.when(F.size(words) > 2, F.transform(F.slice(words, 2, F.size(words) - 2), first)).otherwise(F.array().cast("array<string>"))
        return F.concat_ws(" ", words[0], F.when(F.size(given) > 0, F.array_join(given, " ")), made(F.lit("last"), F.element_at(words, -1)))

    def one(e: Column) -> Column:
        return _let(F.when(e["kind"] == "name", person(e["canon"])).otherwise(made(e["kind"], e["canon"])), lambda m: rendered(e["kind"], e["found"], m))

    step = lambda name: F.col(f"{own}.{name}")
    put = lambda df, **new: df.withColumn(own, F.struct(*([f"{own}.*"] if own in df.columns else []), *[c.alias(n) for n, c in new.items()]))
    parts = put(held, found=entities_of(text))
    some = F.size(F.coalesce(step("found"), F.array())) > 0
    parts = put(parts, new=F.when(some, F.transform(step("found"), one)))
    between = F.split(text, ENTITY, -1)
    whole = F.array_join(F.transform(between, lambda p, i: F.concat(p, F.coalesce(F.try_element_at(step("new"), i + 1), F.lit("")))), "")
    untitled = lambda name: F.regexp_replace(name, TITLE, "")
    full = F.filter(F.transform(step("found"), lambda e, i: F.struct(untitled(e["found"]).alias("name"), untitled(step("new")[i]).alias("new"), e["kind"].alias("kind"))), lambda x: (x["kind"] == "name") & x["name"].contains(" "))
    names = F.flatten(F.transform(full, lambda x: F.array(*[F.struct(as_(x["name"]).alias("name"), as_(x["new"]).alias("new")) for as_ in (lambda c: c, F.upper, F.initcap)])))
    bare = lambda x: F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), x["name"], F.lit(r"\E(?![\p{L}\-])"))
    again_named = F.aggregate(step("names"), F.struct(step("whole").alias("text"), F.lit(0).alias("n")), lambda held, x: F.struct(F.regexp_replace(held["text"], bare(x), x["new"]).alias("text"), (held["n"] + F.regexp_count(held["text"], bare(x))).alias("n")))
    done = put(parts, whole=F.when(some, whole), names=F.when(some, F.array_distinct(names)))
    done = put(done, named=F.when(F.size(step("names")) > 0, again_named))
    kept = [F.coalesce(step("named.text"), step("whole"), text).alias(c) if c == "text" else F.col(c) for c in columns]
    return done.select(*kept, F.when(some, F.size(step("found")) + F.coalesce(step("named.n"), F.lit(0))).otherwise(0).cast("long").alias("n_entities"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), QUERY_KEY)
