"""Surrogates for personal data and secrets, with DataFrame functions only.

Entities are found by patterns and taken apart into atoms: a mail address into its user and
its domain, a name into given and family names, a phone number into its digits. Every
distinct atom gets one surrogate, made from a keyed digest in the atom's own form; a check
over all of them gives another to those that meet another surrogate or a real value. So
equal atoms stay equal wherever they stand and however they are written, and different
ones stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import free_name, lookup, without, written

# Titles by gender, frequent given names by gender, and syllables by script.
TITLES = {
    "m": "Mr Sir Herr Monsieur Señor Lord Господин Κύριος".split(),
    "f": "Mrs Ms Miss Madam Lady Frau Fräulein Madame Mme Mlle Mademoiselle Señora Señorita Госпожа Κυρία".split(),
    "n": "Dr Prof".split(),
}
GIVEN = {
    "m": (
        "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew Peter Hans Karl "
        "Klaus Jürgen Pierre Jacques Jean Michel José Carlos Miguel Antonio Juan Luis Иван Пётр Сергей Дмитрий Γιώργος Νίκος"
    ).split(),
    "f": (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Margaret Sandra Emily Anna Ursula Monika Petra "
        "Sabine Marie Nathalie Isabelle Sylvie María Carmen Ana Laura Lucía Ольга Елена Мария Наталья Μαρία Ελένη"
    ).split(),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ga go ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te to va ve vi".split(),
    "cyrillic": "ба бе би бо ва ве ви га го да де до за зо ка ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са со та то".split(),
    "greek": "βα βε γα γο δα δε δι ζα θα θε κα κε κο λα λε λι μα με μι να νε νο πα πε ρα ρε ρο σα σε τα τε το φα φι".split(),
}
#: Endings of given names by script and gender, and of family names.
ENDINGS = {
    "latin": {"m": "n", "f": "a", "n": "el", "s": "rd"}, "cyrillic": {"m": "н", "f": "я", "n": "ь", "s": "ов"},
    "greek": {"m": "ς", "f": "η", "n": "ι", "s": "ου"},
}

_WORD = r"\p{Lu}[\p{L}'’-]+"
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_NAME = "|".join(n for names in GIVEN.values() for n in names)
SECRET = r"(?i:password|passwd|token|secret|api[_-]?key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
# A mail's user begins where letters and digits begin and has at most 64 characters, a domain at most 126
# labels: so no start reads far, and the repeated group, which Java matches by recursion, stays shallow.
PATTERN = "|".join(
    [
        r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}",
        r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\w)",
        r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
        r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)",
        r"(?<![\w(])(?:(?<![.-])1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)",
        r"(?<![\w.-])(?:1[ .-])?(?:\d{3}[.-]\d{3}[.-]\d{4}|\d{3} \d{3}[ .-]\d{4})(?![\w-])",
        r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
        r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
        rf"(?<![\p{{L}}\d]){SECRET}[A-Za-z0-9_-]{{8,}}",
        rf"(?<![\p{{L}}\d])(?:(?:{_TITLE})\.? (?:{_WORD})(?: {_WORD}){{0,2}}|(?:{_NAME}) {_WORD})",
    ]
)
#: Trials after which a surrogate may grow longer than its original, may be a real value of
#: another entity (formats without room), and gives up its form.
GROWS, MEETS, GIVES_UP = 8, 24, 48
DIGESTS = 4


def kind_of(entity: Column) -> Column:
    return (
        F.when(entity.contains("@"), "mail")
        .when(entity.rlike(r"^AKIA|[=:]"), "secret")
        .when(entity.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "address")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "number")
        .when(entity.rlike(r"^[+(]|^1[ .-]?\(|^(1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}$"), "phone")
        .when(entity.rlike(r"^\d"), "card")
        .otherwise("name")
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _atom(kind: Column | str, value: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), value.alias("value"))


def _digits(entity: Column) -> Column:
    return F.regexp_replace(entity, r"\D", "")


def atoms_of(entity: Column) -> Column:
    """The atoms of an entity in order, as (kind, value)."""
    user, domain = F.lower(F.regexp_extract(entity, r"^(.*)@", 1)), F.lower(F.regexp_extract(entity, r"@(.*)\.[A-Za-z]+$", 1))
    secret = F.regexp_extract(entity, rf"^(?:AKIA|{SECRET})(.*)$", 1)
    words = _words(entity)
    first = F.regexp_replace(entity, r"\.? .*$", "")
    gender = F.when(first.isin(TITLES["m"] + GIVEN["m"]), "m").when(first.isin(TITLES["f"] + GIVEN["f"]), "f").otherwise("n")

    def part(word: Column, i: Column) -> Column:
        role = F.when(i + 1 == F.size(words), "s").otherwise(gender)
        return _atom(F.concat(_script(word), F.lit("-"), role), F.lower(word))

    kind = kind_of(entity)
    return (
        F.when(kind == "mail", F.array(_atom("mail", user), _atom("domain", domain)))
        .when(kind == "secret", F.array(_atom("secret", secret)))
        .when(kind == "address", F.array(_atom("address", entity)))
        .when(kind == "name", F.transform(words, part))
        # A phone number is the same with its country code and without.
        .when(kind == "phone", F.array(_atom(kind, F.substring(_digits(entity), -10, 10))))
        .otherwise(F.array(_atom(kind, _digits(entity))))
    )


def _code(entity: Column) -> Column:
    """The digits of a phone number in front of the last ten."""
    digits = _digits(entity)
    return F.substring(digits, F.lit(1), F.greatest(F.length(digits) - 10, F.lit(0)))


def _words(entity: Column) -> Column:
    """The words of a name without its title."""
    return F.split(F.regexp_replace(entity, rf"^(?:{_TITLE})\.? ", ""), " ")


def _picked(alphabet: str, byte: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(byte, F.lit(len(alphabet))) + 1, F.lit(1))


LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _luhn(digits: Column) -> Column:
    """The Luhn sum by 10: 0 for a valid number."""
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), weighed), F.lit(0), lambda a, x: a + x) % 10


def _stream(kind: Column, value: Column, key: str, trial: int) -> Column:
    """The keyed digits that the trial-th surrogate of an atom is made from."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, F.lit(str(trial)))
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"\x1f{i}")).cast("binary"), 256) for i in range(DIGESTS)])


def surrogate(kind: Column, value: Column, stream: Column, trial: int) -> Column:
    """The trial-th surrogate of an atom: lower-case words, strings and numbers of its own form.

    `stream` has to be a column of its own: it is read once for every character of the value.
    """

    def byte(i: Column) -> Column:
        at = F.pmod(i, F.lit(DIGESTS * 32)) * 2 + 1
        return F.conv(F.substring(stream, at.cast("int"), F.lit(2)), 16, 10).cast("int")

    def like(c: Column, i: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), _picked(DIGIT, byte(i)))
            .when((kind == "secret") & c.rlike("[a-f]"), _picked("abcdef", byte(i)))
            .when(c.rlike("[a-z]"), _picked(LOWER, byte(i)))
            .when(c.rlike("[A-Z]"), _picked(UPPER, byte(i)))
            .otherwise(c)
        )

    longer = max(0, trial - GROWS + 1)
    more = F.concat(F.lit(""), *[_picked(LOWER, byte(F.lit(64 + i))) for i in range(longer)])
    text = F.concat(F.array_join(F.transform(F.split(value, ""), like), ""), more)
    n = F.length(value)

    def digit(i: Column, low: int = 0) -> Column:
        return (F.lit(low) + F.pmod(byte(i), F.lit(10 - low))).cast("string")

    # Area codes do not begin with 0 or 1.
    phone = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i == 1, digit(i, 2)).otherwise(digit(i))), "")
    # The first digit tells the issuer; a valid check digit stays valid, and an invalid one invalid.
    body = F.concat(F.substring(value, 1, 1), F.array_join(F.transform(F.sequence(F.lit(2), n - 1), lambda i: digit(i)), ""))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    card = F.concat(body, F.pmod(check + F.when(_luhn(value) == 0, 0).otherwise(1 + F.pmod(byte(n), F.lit(9))), F.lit(10)).cast("string"))
    number = F.concat((F.lit(1) + F.pmod(byte(F.lit(0)), F.lit(6))).cast("string"), F.array_join(F.transform(F.sequence(F.lit(2), n), lambda i: digit(i, 1)), ""))
    # Private networks stay private.
    part = F.split(value, r"\.")
    octet = [(F.lit(1) + F.pmod(byte(F.lit(i)), F.lit(254))).cast("string") for i in range(4)]
    inner = (part[0] == "10") | (part[0] == "127")
    pair = (part[0] == "192") & (part[1] == "168") | (part[0] == "172") & part[1].cast("int").between(16, 31)
    address = F.concat_ws(
        ".", F.when(inner | pair, part[0]).otherwise((F.lit(11) + F.pmod(byte(F.lit(0)), F.lit(100))).cast("string")),
        F.when(pair, part[1]).otherwise(octet[1]), octet[2], octet[3],
    )
    out = F.when(kind.isin("mail", "domain", "secret"), text).when(kind == "phone", phone).when(kind == "card", card)
    out = out.when(kind == "number", number).when(kind == "address", address)
    for script, syllables in SYLLABLES.items():
        count = 2 + longer
        parts = [F.element_at(F.array(*[F.lit(s) for s in syllables]), F.pmod(byte(F.lit(i)) * 256 + byte(F.lit(i + 32)), F.lit(len(syllables))) + 1) for i in range(count + 1)]
        for role, ending in ENDINGS[script].items():
            out = out.when(kind == f"{script}-{role}", F.concat(*parts, F.lit(ending)))
    return out if trial < GIVES_UP else F.substring(stream, 1, 32)


def surrogates(atoms: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct atoms: by kind, different values have different surrogates,
    and none is a real value, unless a format has no room for that."""
    todo = written(atoms.select("kind", "value"), "atoms")
    real = todo.select("kind", F.col("value").alias("surrogate"))
    done: DataFrame | None = None
    for trial in range(GIVES_UP + 1):
        kind, value = F.col("kind"), F.col("value")
        tried = todo.withColumn("stream", _stream(kind, value, key, trial)).select(kind, value, surrogate(kind, value, F.col("stream"), trial).alias("surrogate"))
        fine = tried.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        if trial < MEETS:
            fine = fine.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            fine = fine.join(done, ["kind", "surrogate"], "left_anti")
        fine = written(fine.select("kind", "value", "surrogate"), "surrogates")
        done = fine if done is None else done.unionByName(fine)
        todo = written(todo.join(fine, ["kind", "value"], "left_anti"), "atoms")
        if todo.isEmpty():
            break
    return done


def _cased(word: Column, like: Column) -> Column:
    """The word in the case of another: capitals, a capital first, or small."""
    return F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(word)).when(F.initcap(like) == like, F.initcap(word)).otherwise(word)


def _dialled(entity: Column, digits: Column) -> Column:
    """The entity with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))

    def step(a: Column, c: Column) -> Column:
        number = c.rlike("[0-9]")
        return F.struct(
            F.concat(a["out"], F.when(number, F.substring(digits, a["i"], F.lit(1))).otherwise(c)).alias("out"),
            (a["i"] + F.when(number, 1).otherwise(0)).alias("i"),
        )

    return F.aggregate(F.split(entity, ""), start, step)["out"]


def rendered(entity: Column, parts: Column) -> Column:
    """The entity with the surrogates of its atoms in place of them."""
    kind = kind_of(entity)
    user = F.regexp_extract(entity, r"^(.*)@", 1)
    mail = F.concat(_cased(parts[0], user), F.lit("@"), parts[1], F.regexp_extract(entity, r"(\.[A-Za-z]+)$", 1))
    secret = F.concat(F.regexp_extract(entity, rf"^(AKIA|{SECRET})", 1), parts[0])
    title = F.regexp_extract(entity, rf"^((?:{_TITLE})\.? )", 1)
    name = F.concat(title, F.array_join(F.zip_with(parts, _words(entity), _cased), " "))
    return (
        F.when(kind == "mail", mail).when(kind == "secret", secret).when(kind == "address", parts[0]).when(kind == "name", name)
        .when(kind == "phone", _dialled(entity, F.concat(_code(entity), parts[0])))
        .otherwise(_dialled(entity, parts[0]))
    )


def replaced(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The frame with surrogates in the text, and n_entities.

    Found are mail addresses, IPv4 addresses, phone, card and social security numbers, access
    keys, values behind `password=` and the like, and names behind a title or that begin with
    a frequent given name. A mail's user of more than 64 characters is not found. `key` is the secret that the surrogates depend on: the same key gives the
    same surrogates for the same corpus. What is not found stays as it is, null text too.
    A column named n_entities is replaced. `docs` must be a scan or another frame whose
    partitions are the same when computed again.
    """
    docs = without(docs, "n_entities")
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)).alias("e"))
    found = written(found.filter(F.size("e") > 0), "entities")
    places = found.select("row", F.posexplode("e").alias("at", "entity"))
    entities = written(places.groupBy("entity").agg(F.count(F.lit(1)).alias("n")), "distinct-entities")
    parts = entities.select("entity", F.posexplode(atoms_of(F.col("entity"))).alias("i", "atom")).select("entity", "i", "atom.kind", "atom.value")
    # How many entities hold an atom: a domain may be in most of the mail addresses.
    atoms = written(parts.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")), "distinct-atoms")
    known = surrogates(atoms, key).join(atoms, ["kind", "value"])
    known = written(known.select(F.struct("kind", "value").alias("atom"), "surrogate", "n"), "known-atoms")
    total = max(1, parts.count())
    joined = lookup(parts.select("entity", "i", F.struct("kind", "value").alias("atom")), known, "atom", "n", total)
    lists = joined.groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("i", "surrogate"))).alias("p"))
    new = lists.join(entities, "entity").select("entity", "n", rendered(F.col("entity"), F.col("p.surrogate")).alias("new"))
    new = written(new, "rendered")
    put = lookup(places, new, "entity", "n", max(1, places.count()))
    row, mine = free_name(docs, "__row"), free_name(docs, "__new")
    rows = put.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("p"))
    rows = rows.select(F.col("row").alias(row), F.col("p.new").alias(mine))
    whole = docs.withColumn(row, F.monotonically_increasing_id()).join(rows, row, "left")
    gaps = F.split(F.col(text), PATTERN, -1)
    filled = F.array_join(F.zip_with(gaps, F.concat(F.col(mine), F.array(F.lit(""))), lambda gap, x: F.concat(gap, x)), "")
    columns = [F.when(F.col(mine).isNull(), F.col(text)).otherwise(filled).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return whole.select(*columns, F.when(F.col(mine).isNull(), 0).otherwise(F.size(mine)).cast("long").alias("n_entities"))
