"""Surrogates for personal data, with DataFrame functions only.

Detected: e-mail addresses, IPv4 addresses, payment cards that pass Luhn's check, telephone and US social-security numbers, IBANs that
pass the mod-97 check, and names behind a title. Each is replaced by a surrogate of its own type that follows from a key and the
entity's canonical form alone, so the same entity gets the same surrogate everywhere, however it is written:

* address: letters and digits of the local part keep their places; the domain is one of the reserved example domains;
* IPv4: a private address stays private, others stay public;
* card: the first digit, the grouping and a valid check digit; telephone: the country code and the grouping; social-security
  number: the grouping, in the range that is never issued; IBAN: the country, the length, the grouping and valid check digits;
* name: the title, the gender that the title or else the given name shows, the script (Latin, Cyrillic or Greek), the number of words.
  The gender is part of the canonical form, and each word has its own surrogate, so a surname alone still goes with the full name:
  "Mr Lee" and "Mr Bob Lee" share theirs. Names are found behind a title or a phrase that introduces one, up to four words of them.

Distinct entities must stay distinct, and no surrogate may be an entity of the texts: the surrogates of all distinct entities are
grouped, all but the first of a group draw again with the next attempt, and so on until none collide; after ``ROUNDS`` rounds the
space of a type is exhausted, which is an error. All ways to write an entity have surrogates of one canonical form, so checking one
of them checks all. What needed more than its first attempt is a small table that the texts are joined with by id; usually it is empty.
Texts are matched once and kept cut at their matches in the scratch folder.

Defined results. Null text: null, without entities. Empty tables give empty ones. Repeated rows: equal values. Very long texts are
read whole; no pattern can backtrack over more than one word. Other columns stay as they are with ``pseudonymise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import Scratch

#: What is looked for, in this order where two would begin at one place.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)"
CARD = r"(?<![\d.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d|-\d)"
PHONE = r"\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .-]\d{2,4}){3,5}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
MALE, FEMALE, EITHER = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος"), ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Госпожа", "Κυρία"), ("Dr", "Prof", "Доктор")
INTRODUCED = ("My name is", "Name:")
#: Small words inside a name, which stay as they are.
PARTICLES = ("van", "von", "der", "den", "de", "del", "la", "di", "da", "du", "bin", "al")
TITLES = "|".join(sorted(MALE + FEMALE + EITHER + INTRODUCED, key=len, reverse=True))
WORD = r"\p{Lu}\p{Ll}{1,40}(?:[-'’]\p{Lu}\p{Ll}{1,40})?"
NAME = rf"(?<![\p{{L}}\d])(?:{TITLES})(?:\. |\.| ){WORD}(?:(?: (?:{'|'.join(PARTICLES)})){{0,3}} {WORD}){{0,3}}(?!\p{{L}})"
STARTS = "".join(sorted({t[0] for t in MALE + FEMALE + EITHER + INTRODUCED}))
#: Attempts after which no free surrogate is expected any more.
ROUNDS = 100


def _any(*patterns: str) -> str:
    """One of the patterns; what may begin a match is looked at first, so that most places fail at once."""
    digits = "|".join(p for p in (PHONE, IPV4, CARD, SSN) if p in patterns)
    parts = [EMAIL] * (EMAIL in patterns) + [f"(?=[{STARTS}]){NAME}"] + [f"(?=[A-Z]){IBAN}"] * (IBAN in patterns) + [f"(?=[0-9+(])(?:{digits})"] * bool(digits)
    return "|".join(parts).replace(r"([ -])", r"(?<gap>[ -])").replace(r"\1", r"\k<gap>")


#: What a text can hold by the characters in it: with an at sign, with digits, with neither.
ANY, NO_AT, ONLY_NAMES = _any(EMAIL, IBAN, PHONE, IPV4, CARD, SSN), _any(IBAN, PHONE, IPV4, CARD, SSN), _any()
#: A private-use character that marks matches.
MARK = "\ue000"
#: Entities beyond their first attempt of so many documents are sent to all tasks; more are joined.
SMALL = 50_000
#: Given names by gender; surnames and other scripts come from syllables.
GIVEN = {"m": ("Adam", "Bruno", "Carl", "David", "Erik", "Felix", "Georg", "Henry", "Ivan", "Jonas", "Karl", "Lukas", "Martin", "Nils", "Oscar", "Peter"), "f": ("Alice", "Berta", "Clara", "Diana", "Emma", "Frida", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olivia", "Paula")}
SYLLABLES = {"latin": ("ba", "de", "fo", "gu", "ki", "la", "me", "no", "pu", "ri", "sa", "te", "vo", "wu", "zi", "ha"), "cyrillic": ("ба", "де", "фо", "гу", "ки", "ла", "ме", "но", "пу", "ри", "са", "те", "во", "жу", "зи", "ха"), "greek": ("βα", "δε", "φο", "γυ", "κι", "λα", "με", "νο", "πυ", "ρι", "σα", "τε", "βο", "θυ", "ζι", "χα")}
ENDINGS = {"cyrillic": {"m": "ов", "f": "ова", "n": "ко"}, "greek": {"m": "ος", "f": "ου", "n": "ας"}, "latin": {"m": "son", "f": "son", "n": "son"}}
GIVEN_ENDINGS = {"cyrillic": {"m": "н", "f": "а", "n": "н"}, "greek": {"m": "ς", "f": "α", "n": "ς"}, "latin": {"m": "o", "f": "a", "n": "i"}}
DOMAINS = ("example.com", "example.net", "example.org")


def _luhn(digits: Column) -> Column:
    """The sum that a valid number's digits bring to a multiple of ten."""
    chars = F.reverse(F.split(digits, ""))
    values = F.transform(chars, lambda c, i: F.when(i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _mod97(iban: Column) -> Column:
    """An IBAN's remainder, without spaces."""
    moved = F.split(F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4)), "")
    return F.aggregate(moved, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def kind_of(raw: Column) -> Column:
    """The type of a match, null if its check fails."""
    digits, plain = F.regexp_replace(raw, "[^0-9]", ""), F.regexp_replace(raw, " ", "")
    shape = F.when(F.contains(raw, F.lit("@")), "email").when(raw.rlike(f"^(?:{IPV4})$"), "ipv4").when(raw.rlike(f"^(?:{SSN})$"), "ssn").when(raw.rlike(f"^(?:{PHONE})$"), "phone")
    shape = shape.when(raw.rlike(f"^(?:{IBAN})$"), F.when(_mod97(plain) == 1, "iban"))
    return shape.when(raw.rlike("^[0-9]"), F.when(_luhn(digits) % 10 == 0, "card")).otherwise("name")


def _gender(raw: Column) -> Column:
    """m, f or n of a name with its title."""
    said, first = F.regexp_extract(raw, rf"^({TITLES})", 1), F.lower(F.regexp_extract(raw, rf"^(?:{TITLES})(?:\. |\.| )({WORD})", 1))
    lower = {g: [n.lower() for n in names] for g, names in GIVEN.items()}
    return F.when(said.isin(*MALE), "m").when(said.isin(*FEMALE), "f").when(first.isin(*lower["m"]), "m").when(first.isin(*lower["f"]), "f").otherwise("n")


def canonical(kind: Column, raw: Column) -> Column:
    """What all ways to write an entity have in common; of a name the gender and its words."""
    name = F.concat_ws(" ", _gender(raw), F.lower(F.regexp_replace(raw, rf"^(?:{TITLES})(?:\. |\.| )", "")))
    return F.when(kind == "email", F.lower(raw)).when(kind == "ipv4", raw).when(kind == "iban", F.regexp_replace(raw, " ", "")).when(kind == "name", name).otherwise(F.regexp_replace(raw, "[^0-9]", ""))


def pieces_of(text: Column) -> Column:
    """A text cut at its matches: what is at odd places (from 0) is a match. One pass of one pattern."""
    def cut(pattern: str) -> Column:
        marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        apart = F.array_compact(F.flatten(F.transform(F.split(text, pattern, -1), lambda p, i: F.array(p, F.get(found, i)))))
        return F.when(F.contains(text, F.lit(MARK)), apart).otherwise(marked)

    return F.when(F.contains(text, F.lit("@")), cut(ANY)).when(text.rlike("[0-9]"), cut(NO_AT)).otherwise(cut(ONLY_NAMES))


def entities_of(pieces: Column) -> Column:
    """An array of (kind, raw, canon) of a text's entities, in order, also those that repeat; kind is null if a match fails its check."""
    raws = F.filter(pieces, lambda p, i: i % 2 == 1)
    found = F.transform(raws, lambda r: F.struct(kind_of(r).alias("kind"), r.alias("raw")))
    return F.transform(found, lambda x: F.struct(x["kind"].alias("kind"), x["raw"].alias("raw"), canonical(x["kind"], x["raw"]).alias("canon")))


def _digits(hash_: Column) -> Column:
    return F.translate(hash_, "abcdef", "083417")


def _pick(values: tuple[str, ...], hash_: Column, at: int) -> Column:
    """One of values, by the two hex digits at a place."""
    return F.element_at(F.array(*map(F.lit, values)), (F.conv(F.substring(hash_, at, 2), 16, 10).cast("int") % len(values) + 1).cast("int"))


def _poured(raw: Column, digits: Column) -> Column:
    """raw with its k-th digit replaced by that of digits."""
    def put(state: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(state["out"], F.when(digit, F.substr(digits, state["k"], F.lit(1))).otherwise(c)).alias("out"), (state["k"] + digit.cast("int")).alias("k"))

    return F.aggregate(F.split(raw, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), put)["out"]


def _word(script: str, hash_: Column, at: int, syllables: Column) -> Column:
    """A capitalised word of syllables by the hash's hex digits."""
    table = F.array(*map(F.lit, SYLLABLES[script]))
    parts = F.transform(F.sequence(F.lit(0), syllables - 1), lambda i: F.element_at(table, (F.conv(F.substr(hash_, i + at, F.lit(1)), 16, 10).cast("int") + 1).cast("int")))
    return F.initcap(F.array_join(parts, ""))


def _name(raw: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The title, and a surrogate of each word of canon: the last is a surname, those before it are given names of the gender."""
    title, gender = F.regexp_extract(raw, rf"^((?:{TITLES})(?:\. |\.| ))", 1), F.substring(canon, 1, 1)
    words = F.split(F.substr(canon, F.lit(3)), " ")

    def of(word: Column, at: Column) -> Column:
        last = at == F.size(words) - 1
        hash_ = F.sha2(F.concat_ws("\x00", F.lit(key), F.lit("word"), F.when(last, "").otherwise(gender), word, attempt.cast("string")), 256)

        def full(script: str) -> Column:
            ending = F.when(gender == "m", ENDINGS[script]["m"]).when(gender == "f", ENDINGS[script]["f"]).otherwise(ENDINGS[script]["n"])
            surname = F.concat(_word(script, hash_, 1, F.least(4 + F.floor(attempt / 2).cast("int"), F.lit(16))), ending if script != "latin" else F.lit(ENDINGS[script]["n"]))
            made = F.concat(_word(script, hash_, 20, F.least(2 + F.floor(attempt / 4).cast("int"), F.lit(12))), F.element_at(F.create_map(*(F.lit(x) for g, e in GIVEN_ENDINGS[script].items() for x in (g, e))), gender))
            known = F.when(gender == "m", _pick(GIVEN["m"], hash_, 60)).when(gender == "f", _pick(GIVEN["f"], hash_, 60)).otherwise(_pick(GIVEN["m"][:8] + GIVEN["f"][:8], hash_, 60))
            # few given names are known: later attempts make them up
            given = F.when(attempt < 4, known).otherwise(made) if script == "latin" else made
            return F.when(last, surname).otherwise(given)

        made = F.when(word.rlike(r"\p{IsCyrillic}"), full("cyrillic")).when(word.rlike(r"\p{IsGreek}"), full("greek")).otherwise(full("latin"))
        return F.when(word.isin(*PARTICLES) & ~last, word).otherwise(made)

    return F.concat(title, F.array_join(F.transform(words, of), " "))


def surrogate(kind: Column, raw: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity as written in raw; its canonical form depends on kind, canon, attempt and key only."""
    hash_ = F.sha2(F.concat_ws("\x00", F.lit(key), kind, canon, attempt.cast("string")), 256)
    more = F.sha2(F.concat(hash_, F.lit("more")), 256)
    digits = _digits(hash_)
    letters = F.concat(F.translate(hash_, "0123456789", "ghijklmnop"), F.translate(more, "0123456789", "qrstuvwxyz"))
    local, n = F.regexp_extract(raw, "^([^@]*)@", 1), F.length(canon)
    shaped = F.array_join(F.transform(F.split(local, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substr(digits, i % 60 + 1, F.lit(1))).when(c.rlike(r"\p{Lu}"), F.upper(F.substr(letters, i + 1, F.lit(1)))).when(c.rlike(r"[\p{L}\p{N}]"), F.substr(letters, i + 1, F.lit(1))).otherwise(c)), "")
    email = F.concat(shaped, F.lit("@"), F.substring(letters, 70, 8), F.lit("."), _pick(DOMAINS, hash_, 62))
    octet = [F.conv(F.substring(hash_, 1 + 4 * k, 4), 16, 10).cast("int") for k in range(4)]
    private = raw.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.)")
    ipv4 = F.concat_ws(".", F.when(private, F.lit(10)).otherwise(octet[0] % 90 + 20).cast("string"), *((o % 254 + 1).cast("string") for o in octet[1:]))
    body = F.concat(F.substring(canon, 1, 1), F.substr(digits, F.lit(1), n - 2))
    card = F.concat(body, F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    code = F.greatest(n - 10, F.lit(0))
    phone = F.concat(F.substr(canon, F.lit(1), code), F.translate(F.substring(digits, 1, 1), "01", "25"), F.substr(digits, F.lit(2), n - code - 1))
    ssn = F.concat(F.lit("9"), F.substring(digits, 1, 8))
    account = F.array_join(F.transform(F.split(F.substr(canon, F.lit(5)), ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substr(digits, i + 1, F.lit(1))).otherwise(F.upper(F.substr(letters, i + 1, F.lit(1))))), "")
    country = F.substring(canon, 1, 2)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0"), account)
    grouped = F.aggregate(F.split(raw, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), lambda s, c: F.struct(F.concat(s["out"], F.when(c == " ", c).otherwise(F.substr(iban, s["k"], F.lit(1)))).alias("out"), (s["k"] + (c != " ").cast("int")).alias("k")))["out"]
    number = F.when(kind == "card", card).when(kind == "phone", phone).otherwise(ssn)
    return F.when(kind == "email", email).when(kind == "ipv4", ipv4).when(kind == "name", _name(raw, canon, attempt, key)).when(kind == "iban", grouped).otherwise(_poured(raw, number))


def attempts(found: DataFrame, key: str, scratch: Scratch) -> DataFrame | None:
    """(kind, canon, attempt) of the entities whose first surrogate collides, or None. found: (kind, raw, canon), repeats allowed."""
    # one way to write each entity stands for all: the canonical form of its surrogate, the gender of a name included, is that of all
    every = scratch.put("entities", found.groupBy("kind", "canon").agg(F.min("raw").alias("raw")).withColumn("attempt", F.lit(0)))
    own, turn = every.select("kind", F.col("canon").alias("new"), F.lit(1).alias("real")), 0
    while True:
        # written down, so that the surrogates are made once for the joins that follow
        tried = scratch.put(f"tried-{turn}", every.withColumn("new", canonical(F.col("kind"), surrogate(F.col("kind"), F.col("raw"), F.col("canon"), F.col("attempt"), key))))
        first = tried.groupBy("kind", "new").agg(F.min(F.struct("attempt", "canon")).alias("first"), F.count("*").alias("n"))
        bad = first.join(own, ["kind", "new"], "left").filter("n > 1 or real is not null").select("kind", "new", F.when(F.col("real").isNull(), F.col("first.canon")).alias("stays"))
        bad = scratch.put(f"bad-{turn}", tried.join(bad, ["kind", "new"]).filter("stays is null or canon <> stays").select("kind", "canon", F.lit(1).alias("again")))
        if bad.isEmpty():
            break
        turn += 1
        if turn > ROUNDS:
            raise ValueError(f"no distinct surrogates after {ROUNDS} attempts: a type has more entities than surrogates")
        every = tried.drop("new").join(bad, ["kind", "canon"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0))).drop("again")
    every = tried.drop("new")
    return every.filter("attempt > 0").select("kind", "canon", "attempt") if turn else None


def pseudonymise(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, text, entities) and the columns named in ``keep``: entities is an array of (kind, surrogate) in the text's order. Its name
    gets an underscore if a kept column has it."""
    scratch, name = Scratch(docs.sparkSession, "pii"), "entities"
    while name in {c.lower() for c in (key, text, *keep)}:
        name += "_"
    kept = F.struct(*(F.col(c) for c in keep)) if keep else F.lit(None).cast("int")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), kept.alias("kept")).withColumn("pieces", pieces_of(F.col("text")))
    # a text without a match is its only piece
    rows = scratch.put("pieces", rows.select("id", "kept", "pieces", entities_of(F.col("pieces")).alias("found")))
    found = scratch.put("found", rows.filter(F.size("found") > 0).select("id", F.explode("found").alias("e")).select("id", "e.*").filter("kind is not null"))
    more = attempts(found, secret, scratch)
    if more is None:
        attempt = lambda e: F.lit(0)
    else:
        own = found.select("id", "kind", "canon").distinct().join(more, ["kind", "canon"])
        own = own.groupBy(F.col("id").alias("own")).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x00", "kind", "canon"), "attempt"))).alias("more"))
        own = scratch.put("own", own)
        own = F.broadcast(own) if own.count() <= SMALL else own
        rows = rows.join(own, F.col("id").eqNullSafe(F.col("own")), "left")
        attempt = lambda e: F.coalesce(F.element_at("more", F.concat_ws("\x00", e["kind"], e["canon"])), F.lit(0))
    scratch.drop("found")
    made = F.transform("found", lambda e: F.struct(e["kind"].alias("kind"), F.when(e["kind"].isNull(), e["raw"]).otherwise(surrogate(e["kind"], e["raw"], e["canon"], attempt(e), secret)).alias("surrogate")))
    rows = rows.withColumn("made", F.when(F.size("found") > 0, made).otherwise(F.array().cast("array<struct<kind:string,surrogate:string>>")))
    filled = F.array_join(F.transform("pieces", lambda p, i: F.when(i % 2 == 1, F.get("made", F.floor(i / 2).cast("int"))["surrogate"]).otherwise(p)), "")
    return rows.select(F.col("id").alias(key), F.when(F.col("pieces").isNotNull(), filled).alias(text), F.filter("made", lambda m: m["kind"].isNotNull()).alias(name), *(F.col("kept")[c].alias(c) for c in keep))
