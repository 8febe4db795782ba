"""Personal data replaced by keyed surrogates of the same type, gender, script and format. Built-ins only.

Every entity (a mailbox, its domain, a number by its digits, a name by its parts) gets one surrogate over the whole corpus,
from a keyed hash; surrogates that meet each other or a real entity are drawn again, so distinct entities stay distinct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

# Titles, with the gender they tell, common given names, and phrases that a full name follows.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "Signora"],
    "m": ["Mr", "Herr", "Monsieur", "Sr", "Señor", "Signor"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    "f": [
        "Mary", "Anna", "Emma", "Julia", "Laura", "Sarah", "Elena", "Sophie", "Claire", "Lucia", "Carmen", "Ingrid", "Alice", "Linda", "Susan", "Maria", "María", "Elizabeth", "Jennifer", "Patricia", "Jessica", "Karen", "Nancy",
        "Helen", "Emily", "Olivia", "Hannah", "Charlotte", "Ursula", "Monika", "Petra", "Sabine", "Katrin", "Greta", "Camille", "Chloé", "Manon", "Juliette", "Isabelle", "Nathalie", "Pilar", "Isabel", "Rosa", "Sofía", "Giulia", "Chiara",
        "Francesca", "Анна", "Мария", "Ольга", "Елена", "Наталья", "Μαρία", "Ελένη", "Κατερίνα",
    ],
    "m": [
        "John", "James", "Robert", "Michael", "David", "Thomas", "Peter", "Paul", "Pierre", "Jean", "Carlos", "Hans", "Karl", "Luis", "William", "Tom", "Richard", "Joseph", "Charles", "Daniel", "Matthew", "Anthony", "Andrew", "George",
        "Steven", "Edward", "Henry", "Jürgen", "Klaus", "Wolfgang", "Stefan", "Andreas", "Dieter", "Jacques", "François", "Antoine", "Nicolas", "Julien", "Olivier", "José", "Juan", "Miguel", "Javier", "Pedro", "Antonio", "Giovanni",
        "Marco", "Luca", "Francesco", "Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Γιώργος", "Νίκος", "Δημήτρης",
    ],
}
ANNOUNCING = ["my name is", "My name is", "Name:", "name:", "Contact:", "Patient:", "Dear", "Best regards,", "Kind regards,", "Sincerely,", "signed by", "Signed by", "Ich heiße", "ich heiße", "Mein Name ist", "Je m'appelle", "je m'appelle", "Me llamo", "me llamo"]
#: Syllables of surrogate names by script, and the endings that mark a gender there.
SYLLABLES = {
    "latin": ["ba", "cor", "dan", "el", "fi", "gan", "hel", "is", "jo", "kal", "lin", "mor", "nes", "or", "pel", "rin", "sol", "tar", "ul", "ven"],
    "cyrillic": ["ба", "вор", "гал", "дим", "ел", "жан", "зор", "кам", "лев", "мир", "нов", "ол", "пет", "рад", "сав", "том"],
    "greek": ["αλ", "βα", "γερ", "δι", "ελ", "ζη", "θε", "κα", "λυ", "με", "νι", "πα", "ρο", "σω", "τι", "φι"],
}
ENDINGS = {
    "latin": {"f": "a", "m": "o", "n": "en"},
    "cyrillic": {"f": "а", "m": "ий", "n": "ко"},
    "greek": {"f": "α", "m": "ος", "n": "ου"},
}

#: A part of a name in mixed case (Smith, O'Brien, McDonald, Dupont-Martin), in capitals, and initials that stand between parts.
NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)?(?:-\p{Lu}\p{Ll}+)?"
CAPITALS = r"\p{Lu}['’]?\p{Lu}+(?:-\p{Lu}+)?"
INITIALS = r"(?: \p{Lu}\.){0,2}"
_TITLE = "|".join(t for g in TITLES.values() for t in g)
_GIVEN = "|".join(n for g in GIVEN.values() for n in g)
#: Mentions by type, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)+",
    "ip6": r"(?<![\w:.])(?=[0-9A-Fa-f]{3,4}:)(?=[A-Fa-f:]{0,39}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "ip": r"(?<![\d.])(?<!(?:version|Version|release|Release) )(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])",
    "secret": r"(?<!\w)(?=[a-f]{0,63}\d)[0-9a-f]{32,64}(?!\w)",
    "name": rf"(?<![\w-])(?=\p{{Lu}})(?:(?:{_TITLE})\.? (?:\p{{Lu}}\. ){{0,2}}{NAME}(?:{INITIALS} {NAME})?|(?:\p{{Lu}}\p{{Ll}}+-)?(?:{_GIVEN})(?:-\p{{Lu}}\p{{Ll}}+)?{INITIALS} {NAME}|(?:{_GIVEN.upper()}){INITIALS} {CAPITALS}|(?<=(?:{'|'.join(ANNOUNCING)}) ){NAME}{INITIALS} {NAME})(?!\w)",
}
MENTION = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text with a mention has: a digit, an @, or a word that announces a name. Texts without are passed by.
HINT = rf"[0-9@]|(?<!\w)(?:(?=\p{{Lu}})(?:{_TITLE}|{_GIVEN}|{_GIVEN.upper()})(?!\w)|(?:{'|'.join(ANNOUNCING)}) )"
#: What begins the type of a mailbox; its domain follows.
MAILBOX = "mailbox@"
#: Rounds of drawing again; each draws anew for the few that met, from a space that grows with the attempts.
ROUNDS = 40


def _is(pattern: str) -> str:
    return rf"^(?:{pattern})$"


def kind_of(mention: Column) -> Column:
    """The type of a mention: that of the first pattern that fits it whole; announced and later names stand without what tells
    them, and are the only mentions without a digit or an @."""
    fits = [F.when(mention.rlike(_is(p)), F.lit(k)) for k, p in PATTERNS.items()]
    return F.coalesce(*fits, F.when(~mention.rlike("[0-9@]"), F.lit("name")), F.lit("card"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _cased(part: Column) -> Column:
    """A part of a name as it is written outside capitals, so that SMITH is Smith; O'Brien and McDonald stay."""
    spaced = F.initcap(F.regexp_replace(part, "(['’-])", "$1 "))
    return F.when(part.rlike(rf"^{CAPITALS}$"), F.regexp_replace(spaced, "(['’-]) ", "$1")).otherwise(part)


def _name_tokens(mention: Column) -> Column:
    """The words of a name without its initials."""
    return F.filter(F.split(mention, " "), lambda t: ~t.rlike(r"^\p{Lu}\.$"))


def _surnames(found: Column) -> Column:
    """The last parts of the names among a text's mentions."""
    return F.array_distinct(F.transform(F.filter(found, lambda m: ~m.rlike("[0-9@]")), lambda m: _cased(F.element_at(_name_tokens(m), -1))))


def _mention_of(names: Column) -> Column:
    """The pattern of a text's mentions: those that tell themselves, and the text's surnames wherever they stand again, bare, with
    initials, in the possessive or in capitals."""
    again = F.array_join(F.array_union(names, F.transform(names, F.upper)), "|")
    edge = r"[\p{L}\p{N}_@-]"
    return F.when(F.size(names) > 0, F.concat(F.lit(rf"{MENTION}|(?<!{edge})(?=\p{{Lu}})(?:\p{{Lu}}\. ){{0,2}}(?:"), again, F.lit(rf")(?!{edge})"))).otherwise(F.lit(MENTION))


def _script(x: Column) -> Column:
    return F.when(x.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(x.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))


def _parts(mention: Column, kind: Column) -> Column:
    """The entities of a mention: ``(type, value)`` structs. Names give one for each part, so that a person keeps the
    surname with and without a given name; an address gives its mailbox (of a type of its domain's own) and its domain, which
    so stays common to its mailboxes; numbers are their digits, so that punctuation doesn't matter."""
    titles = {g: [*t, *[x + "." for x in t]] for g, t in TITLES.items()}
    tokens = _name_tokens(mention)
    lead = F.element_at(tokens, 1)
    title = {g: lead.isin(*t) for g, t in titles.items()}
    titled = title["f"] | title["m"] | title["n"]
    rest = F.transform(F.when(titled, F.slice(tokens, 2, 2)).otherwise(tokens), _cased)
    given = F.element_at(rest, 1)
    known = {g: F.arrays_overlap(F.split(given, "-"), F.array(*map(F.lit, GIVEN[g]))) for g in GIVEN}
    gender = F.when(title["f"] | known["f"], F.lit("f")).when(title["m"] | known["m"], F.lit("m")).otherwise(F.lit("n"))
    pair = lambda k, v: F.struct(k.alias("type"), v.alias("value"))
    surname = pair(F.concat(F.lit("surname_"), _script(F.element_at(rest, -1))), F.element_at(rest, -1))
    first = pair(F.concat(F.lit("given_"), gender, F.lit("_"), _script(given)), given)
    name = F.when(F.size(rest) == 2, F.array(first, surname)).when(known["f"] | known["m"], F.array(first)).otherwise(F.array(surname))
    number = F.array(pair(kind, F.when(kind == "iban", F.regexp_replace(mention, " ", "")).otherwise(_digits(mention))))
    low = F.lower(mention)
    domain = F.substring_index(low, "@", -1)
    address = F.array(pair(F.concat(F.lit(MAILBOX), domain), F.substring_index(low, "@", 1)), pair(F.lit("domain"), domain))
    return F.when(kind == "name", name).when(kind.isin("phone", "card", "ssn", "iban"), number).when(kind == "email", address).otherwise(F.array(pair(kind, F.when(kind == "ip6", low).otherwise(mention))))


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """320 keyed numbers from 0 to 255 for an entity, as hexadecimal digits."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string"))
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"\x1f{i}")), 512) for i in range(5)])


def _number(stream: Column, i: Column, below: int) -> Column:
    """The i-th (from 1) number of a stream, reduced below a bound."""
    at = F.pmod(i - 1, F.lit(300)) * 2 + 1
    return F.pmod(F.conv(F.substring(stream, at, F.lit(4)), 16, 10).cast("int"), F.lit(below))


def _shaped(value: Column, stream: Column, hexadecimal: Column) -> Column:
    """The value with every letter and digit replaced by another of its class; other characters stay."""

    def one(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        pick = lambda s: F.substring(F.lit(s), _number(stream, i, len(s)) + 1, F.lit(1))
        return (
            F.when(hexadecimal & c.rlike("[0-9a-f]"), pick("0123456789abcdef"))
            .when(c.rlike("[0-9]"), pick("0123456789"))
            .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""

    def one(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda s, x: s + x) % 10


def _mod97(iban: Column) -> Column:
    """An IBAN modulo 97, its first four characters moved to the end and letters read as 10 to 35; 1 where it is valid."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(sum_: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code >= 65, (sum_ * 100 + code - 55) % 97).otherwise((sum_ * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)


def drawn(state: DataFrame, key: str) -> DataFrame:
    """``type, value, attempt`` rows with their ``surrogate``: of its type and format, and for names of its gender and script.

    Mailboxes keep their shape, domains theirs under a reserved one, phone numbers their first digit, cards and IBANs the
    validity of their check digits, IBANs their country, IP addresses are valid ones; the number of digits and letters stays.
    With every attempt a name has a syllable more, after a second one a mailbox or domain a letter more and after a fourth one a
    number a digit more, so that the space outgrows any number of entities; an IP address that has found no free one in
    sixteen attempts is followed by a hyphen and letters.
    """
    kind, value, s, free, attempt = (F.col(c) for c in ("type", "value", "_stream", "_free", "attempt"))
    # columns of their own, so that the digest isn't taken anew for every character
    state = state.withColumn("_stream", _stream(key, kind, value, F.col("attempt")))
    state = state.withColumn("_free", _shaped(value, s, kind.isin("secret", "ip6")))

    def more(after: int, signs: str) -> Column:
        pick = lambda i: F.substring(F.lit(signs), _number(s, F.lit(200) + i, len(signs)) + 1, F.lit(1))
        return F.when(attempt <= after, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(attempt - after, F.lit(1))), pick), ""))

    letters, digits = more(2, "abcdefghijklmnopqrstuvwxyz"), more(4, "0123456789")
    labels = F.split(free, r"\.")
    sub = F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(1))), ".")
    domain = F.concat(sub, letters, F.lit(".example."), F.element_at(F.array(*map(F.lit, ["com", "net", "org"])), _number(s, F.lit(290), 3) + 1))
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(s, i, 254) + 1).cast("string")), ".")
    free_ip = F.concat(free, F.when(attempt > 16, F.concat(F.lit("-"), more(16, "abcdefghijklmnopqrstuvwxyz"))).otherwise(F.lit("")))
    ip = F.concat(ip, F.when(attempt > 16, F.concat(F.lit("-"), more(16, "abcdefghijklmnopqrstuvwxyz"))).otherwise(F.lit("")))
    phone = F.concat(F.substring(value, 1, 1), F.substring(free, F.lit(2), F.length(free)), digits)
    stem = F.concat(F.substring(free, F.lit(1), F.length(free) - 1), digits)
    check = F.pmod(10 - _luhn(F.concat(stem, F.lit("0"))), F.lit(10))
    valid = _luhn(value) == 0
    card = F.concat(stem, F.when(valid, check).otherwise(F.pmod(check + 1 + F.pmod(_number(s, F.lit(291), 250), F.lit(9)), F.lit(10))).cast("string"))
    country, account = F.substring(value, 1, 2), F.substring(free, F.lit(5), F.length(free))
    right = 98 - _mod97(F.concat(country, F.lit("00"), account))
    shown = F.when(_mod97(value) == 1, right).when(right == 98, F.lit(3)).otherwise(right + 1)
    iban = F.concat(country, F.lpad(shown.cast("string"), 2, "0"), account)

    def name(script: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        body = F.array_join(F.transform(F.sequence(F.lit(1), F.col("attempt") + 4), lambda i: F.element_at(syllables, _number(s, i, len(SYLLABLES[script])) + 1)), "")
        ends = ENDINGS[script]
        gender = F.when(kind.startswith("given_f"), F.lit(ends["f"])).when(kind.startswith("given_m"), F.lit(ends["m"])).otherwise(F.lit(ends["n"]))
        return F.initcap(F.concat(body, gender))

    out = F.when(kind.startswith(MAILBOX), F.concat(free, letters)).when(kind == "domain", domain).when(kind == "ip", ip).when(kind == "ip6", free_ip)
    out = out.when(kind == "phone", phone).when(kind == "ssn", F.concat(free, digits)).when(kind == "card", card).when(kind == "iban", iban)
    for script in SYLLABLES:
        out = out.when(kind.endswith(f"_{script}"), name(script))
    return state.withColumn("surrogate", out.otherwise(free)).drop("_stream", "_free")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``type, value, surrogate`` for distinct entities (``type, value``), surrogates distinct within each type.

    A surrogate that equals a real entity of its type, or that an entity drawn earlier (then smaller) has, is drawn
    again; every round is two joins of the entities' table and stops when all are settled.
    """
    real = entities.select("type", "value").distinct()
    real = written(real, "entities")
    # one row a type of name: where more names than a sixteenth of the space are known, drawing begins with more syllables
    named = real.where(F.col("type").rlike("^(surname|given)_")).groupBy("type").count().collect()
    begin = F.lit(0)
    for row in named:
        at, size = 0, len(SYLLABLES[row["type"].rsplit("_", 1)[1]])
        while size ** (4 + at) < 16 * row["count"]:
            at += 1
        begin = F.when(F.col("type") == row["type"], F.lit(at)).otherwise(begin) if at else begin
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    state = real.withColumn("attempt", begin)
    for _ in range(ROUNDS):
        table = written(drawn(state.repartition(parts, "type", "value"), key), "surrogates")
        first = table.groupBy("type", "surrogate").agg(F.min(F.struct("attempt", "value"))["value"].alias("holder"))
        clash = real.select("type", F.col("value").alias("surrogate"), F.lit(True).alias("is_real"))
        tried = table.join(first, ["type", "surrogate"]).join(clash, ["type", "surrogate"], "left")
        bad = (F.col("holder") != F.col("value")) | F.coalesce("is_real", F.lit(False))
        if tried.where(bad).limit(1).count() == 0:
            return table.drop("attempt")
        state = tried.select("type", "value", (F.col("attempt") + F.when(bad, 1).otherwise(0)).alias("attempt"))
    raise RuntimeError("surrogates still meet; the value space of a type is too small for its entities")


def _render(mention: Column, kind: Column, parts: Column) -> Column:
    """A mention with its parts' surrogates in its own punctuation and capitals, titles kept; initials are the surrogates' own."""
    one = F.element_at(parts, 1)
    marks = F.when(kind == "iban", F.lit("[A-Za-z0-9]")).otherwise(F.lit("[0-9]"))
    place = lambda i: F.length(F.when(kind == "iban", F.regexp_replace(F.substring(mention, F.lit(1), i), " ", "")).otherwise(_digits(F.substring(mention, F.lit(1), i))))
    refill = F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(mention)), lambda i: F.when(F.regexp_like(F.substring(mention, i, F.lit(1)), marks), F.substring(one, place(i), F.lit(1))).otherwise(F.substring(mention, i, F.lit(1)))), ""
    )
    marked = F.length(F.when(kind == "iban", F.regexp_replace(mention, " ", "")).otherwise(_digits(mention)))
    refill = F.concat(refill, F.substring(one, marked + 1, F.length(one)))  # a surrogate that has grown
    tokens = F.split(mention, " ")
    lead = F.size(_name_tokens(mention)) - F.size(parts)

    def word(token: Column, i: Column) -> Column:
        nth = F.size(F.filter(F.slice(tokens, F.lit(1), i + 1), lambda t: ~t.rlike(r"^\p{Lu}\.$"))) - lead  # from 1; titles come before
        part = F.get(parts, nth - 1)
        initial = F.concat(F.substring(F.coalesce(part, F.element_at(parts, 1)), 1, 1), F.lit("."))
        return F.when(token.rlike(r"^\p{Lu}\.$"), initial).when(token.rlike(rf"^{CAPITALS}$"), F.upper(F.coalesce(part, token))).otherwise(F.coalesce(part, token))

    name = F.array_join(F.transform(tokens, word), " ")
    return F.when(kind == "name", name).when(kind.isin("phone", "card", "ssn", "iban"), refill).when(kind == "email", F.array_join(parts, "@")).otherwise(one)


def replaced(docs: DataFrame, key: str, count: str | None = "n_entities") -> DataFrame:
    """``docs`` with ``text`` rewritten and one more column ``count`` (mentions replaced; none if None); other columns stay.

    A column of ``docs`` that has the count's name stays as it is, and the count is left out. Null and empty texts and those
    without a mention pass untouched. Texts are searched once, and written with what was found; of those with mentions each
    distinct one is taken apart once whatever its copies, so repeated rows are rewritten alike. An entity in many texts is one
    row of the surrogates' table; its mentions meet it in a join that can be split. Surnames that a text tells once are
    mentions wherever the same text has them again. Names starting with ``_pii_`` are reserved.
    """
    text, none = F.col("text"), F.array().cast("array<string>")
    found = F.when(F.coalesce(text.rlike(HINT), F.lit(False)), F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))).otherwise(none)
    marked = docs.withColumn("_pii_found", found).withColumn("_pii_names", _surnames(F.col("_pii_found")))
    again = F.regexp_extract_all(text, _mention_of(F.col("_pii_names")), F.lit(0))
    marked = marked.withColumn("_pii_found", F.when(F.size("_pii_names") > 0, again).otherwise(F.col("_pii_found")))
    marked = written(marked.withColumn("_pii_key", F.when(F.size("_pii_found") > 0, F.sha2("text", 256))), "marked")
    plain, some = marked.where("_pii_key is null"), marked.where("_pii_key is not null")
    mentions = some.select("_pii_key", F.posexplode("_pii_found").alias("place", "mention")).distinct()
    mentions = mentions.withColumn("kind", kind_of(F.col("mention")))
    mentions = mentions.select("_pii_key", "place", "mention", "kind", F.posexplode(_parts(F.col("mention"), F.col("kind"))).alias("nth", "part"))
    mentions = written(mentions.select("_pii_key", "place", "mention", "kind", "nth", "part.type", "part.value"), "mentions")
    table = surrogates(mentions, key)
    parts = mentions.join(table, ["type", "value"]).groupBy("_pii_key", "place", "mention", "kind").agg(F.sort_array(F.collect_list(F.struct("nth", "surrogate")))["surrogate"].alias("parts"))
    shown = parts.select("_pii_key", "place", _render(F.col("mention"), F.col("kind"), F.col("parts")).alias("shown"))
    # one row for each distinct text with mentions: as many surrogates as the text has mentions
    texts = shown.groupBy("_pii_key").agg(F.sort_array(F.collect_list(F.struct("place", "shown")))["shown"].alias("_pii_shown"))
    woven = F.array_join(F.zip_with(F.split(text, _mention_of(F.col("_pii_names")), -1), F.col("_pii_shown"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = plain.unionByName(some.join(texts, "_pii_key").withColumn("text", woven).select(*marked.columns))
    extra = [F.size("_pii_found").cast("long").alias(count)] if count and count not in docs.columns else []
    return out.select(*docs.columns, *extra)
