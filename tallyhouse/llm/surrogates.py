"""Keyed, type-consistent surrogates for personal data, by DataFrame functions.

Found entities (mail and IP addresses, phone, card, social-security and account
numbers, names with an address or a known given name) are replaced by made-up ones
of the same type:

* letters and digits of addresses and numbers go through a keyed cipher that
  shifts each within its class: four rounds in which the characters at even
  places shift those at odd places, and the other way round.  So length, case,
  separators, country and top-level domain stay, and within a type two values
  never get the same surrogate.  Octets shift modulo 256; a valid card number
  gets a new check digit.
* given names come from a list of the same gender and script; family names are
  put together from syllables of the script, one more every few attempts.

One table has every distinct value of the corpus with its surrogate.  A surrogate
that two values share, or that is itself a value of the corpus, is a collision:
all but the first of those values get the surrogate of the next attempt, until
none is left.  As the table is keyed by the normalised value (digits alone, small
letters), every mention of a value gets the same surrogate, in its own format.

Coreference: a word that some mention of a document has as a given or family name is
that name wherever it stands alone in the document ("Mrs Mary Jones ... Jones
replied"), with the part it has in the first of these mentions.  A given name whose
mention tells no gender ("Dr Olivia Brown") is the gendered one of the same letters,
where the corpus has one ("Ms Olivia Brown").
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import written

# Forms of address and given names by gender, and syllables, by script.
ADDRESS = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "n": ("Dr", "Prof"),
}
GIVEN = {
    ("f", "latin"): ("Mary", "Anna", "Laura", "Sophie", "Julia", "Emma", "Clara", "Marta", "Elena", "Alice", "Susan",
                     "Linda", "Karen", "Helen", "Sandra", "Maria", "Sarah", "Lisa", "Nancy", "Ingrid", "Carmen", "Lucia"),
    ("m", "latin"): ("John", "James", "Peter", "Paul", "Thomas", "David", "Robert", "Michael", "Daniel", "Martin",
                     "Georg", "Hans", "Pierre", "Jean", "Carlos", "Pablo", "Miguel", "William", "Richard", "Frank", "Otto"),
    ("f", "cyrillic"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"),
    ("m", "cyrillic"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил"),
    ("f", "greek"): ("Μαρία", "Ελένη", "Άννα", "Σοφία", "Κατερίνα", "Ειρήνη"),
    ("m", "greek"): ("Γιώργος", "Νίκος", "Δημήτρης", "Κώστας", "Γιάννης", "Πέτρος"),
}
SYLLABLES = {
    "latin": ("ba", "den", "lor", "mi", "ran", "sto", "ver", "wal", "ken", "dal", "fer", "gan", "hol", "mar", "nes", "tor"),
    "cyrillic": ("ба", "вер", "го", "дан", "ка", "лов", "ми", "нов", "пет", "ра", "со", "тар", "фе", "хол", "чер", "ша"),
    "greek": ("βα", "δη", "κα", "λο", "μα", "νι", "πα", "ρο", "σα", "τα", "φι", "χα", "γε", "θε", "ζα", "ξε"),
}

_ADDRESSES = "|".join(w for ws in ADDRESS.values() for w in ws)
_GIVENS = "|".join(w for ws in GIVEN.values() for w in ws)
_CAPITAL = r"[\p{Lu}][\p{Ll}]+(?:-[\p{Lu}][\p{Ll}]+)?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_FORMS = {
    # One class for the whole domain: repeated groups would recurse, a level for each label.
    "mail": r"(?<![A-Za-z0-9._%+-])(?=[._%+-]*+[A-Za-z0-9])[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9])[A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z])(?!\.[0-9])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "social": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}])(?:(?:{_ADDRESSES})\.? {_CAPITAL}(?: {_CAPITAL})?|(?:{_GIVENS})(?: {_CAPITAL})?)(?![\p{{L}}])",
}
# What a form may start with is looked at first, as most characters start none.
_STARTS = (("(?=[A-Za-z0-9._%+-])", ("mail",)), ("(?=[0-9])", ("ip",)), (r"(?=\p{Lu})", ("account",)),
           ("(?=[0-9+(])", ("social", "phone", "card")), (r"(?=\p{Lu})", ("name",)))
PATTERN = "|".join(f"{start}(?:{'|'.join(_FORMS[k] for k in kinds)})" for start, kinds in _STARTS)
ROUNDS = 4
LONGER = 3      # attempts after which made-up names get one more syllable
KEPT_LENGTH = 8     # attempts after which numbers and addresses grow, too


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def _number(digest: Column, place: Column | int, modulus: Column | int) -> Column:
    """A number below ``modulus`` from four hex digits of a digest."""
    at = (place % 16) * 4 + 1
    hexes = F.substring(digest, at, 4) if isinstance(place, int) else digest.substr(at.cast("int"), F.lit(4))
    return F.pmod(F.conv(hexes, 16, 10).cast("int"), modulus if isinstance(modulus, Column) else F.lit(modulus))


def kind_of(mention: Column) -> Column:
    out = None
    for kind, form in _FORMS.items():
        bare = F.rlike(mention, F.lit(f"^(?:{form})$"))
        out = F.when(bare, kind) if out is None else out.when(bare, kind)
    return out.otherwise("name")


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(words: Column) -> Column:
    """By the form of address, else by the given name, else unknown."""
    first = F.regexp_replace(words[0], r"\.$", "")
    out = F.lit("n")
    for g in ("m", "f"):
        own = [*ADDRESS[g], *(n for (x, _), names in GIVEN.items() if x == g for n in names)]
        given = F.element_at(words, F.least(F.size(words), F.lit(2)))
        listed = F.array(*map(F.lit, own))
        out = F.when(F.array_contains(listed, first) |
                     (F.array_contains(F.array(*map(F.lit, ADDRESS["n"])), first) & F.array_contains(listed, given)),
                     g).otherwise(out)
    return out


def parts_of(mention: Column) -> Column:
    """A mention's parts as (kind, value, form): one for numbers and addresses; for
    names one a word, forms of address having the kind ``keep``."""

    def part(kind, value, form) -> Column:
        return F.struct(kind.alias("kind"), value.alias("value"), form.alias("form"))

    def of_name(words: Column) -> Column:
        gender = _gender(words)
        address = F.regexp_replace(words[0], r"\.$", "").isin([w for ws in ADDRESS.values() for w in ws])

        def word(w: Column, i: Column) -> Column:
            last = (i == F.size(words) - 1) & (F.size(words) > 1)
            kind = F.when((i == 0) & address, "keep").when(last, F.concat(F.lit("family-"), script_of(w))) \
                .otherwise(F.concat(F.lit("given-"), gender, F.lit("-"), script_of(w)))
            return part(kind, F.lower(w), w)

        return F.transform(words, word)

    def of(kind: Column) -> Column:
        value = F.when(kind == "mail", F.lower(mention)).when(kind == "ip", mention) \
            .when(kind == "account", F.regexp_replace(mention, "[^A-Z0-9]", "")) \
            .otherwise(F.regexp_replace(mention, "[^0-9]", ""))
        return F.when(kind == "name", _let(F.split(mention, " "), of_name)) \
            .otherwise(F.array(part(kind, value, mention)))

    return _let(kind_of(mention), of)


def _shift(c: Column, by: Column) -> Column:
    """A character shifted within its class: digits, small letters, capitals."""
    code = F.ascii(c)
    turn = lambda first, size: F.chr(F.lit(first) + F.pmod(code - first + by, F.lit(size)))
    return F.when(code.between(48, 57), turn(48, 10)).when(code.between(97, 122), turn(97, 26)) \
        .when(code.between(65, 90), turn(65, 26)).otherwise(c)


def _cipher(chars: Column, first: Column, last: Column, seed: list[Column], step) -> Column:
    """The rounds over an array; only places from ``first`` to ``last`` change."""
    def turn(r: int):
        def turned(a: Column) -> Column:
            other = F.array_join(F.transform(a, lambda c, i: F.when((i % 2 != r % 2) | (i < first) | (i > last), c)
                                             .otherwise(F.lit(""))), ",")
            return _let(_digest(*seed, F.lit(str(r)), other), lambda d: F.transform(a, lambda c, i: F.when(
                (i % 2 == r % 2) & (i >= first) & (i <= last),
                step(c, _number(d, i, 65536) + (i / 16).cast("int") * 7)).otherwise(c)))
        return turned

    for r in range(ROUNDS):
        chars = _let(chars, turn(r))
    return chars


def _luhn(digits: Column) -> Column:
    """The sum whose last digit is 0 for a valid number (digits as a string)."""
    return _let(F.reverse(F.split(digits, "")), lambda a: F.aggregate(
        F.transform(a, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            (c.cast("int") * 2 / 10).cast("int") + F.pmod(c.cast("int") * 2, F.lit(10)))),
        F.lit(0), lambda s, x: s + x))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a normalised value; another one for each attempt."""
    seed = [F.lit(key), kind, attempt.cast("string")]

    def shifted(first: Column, last: Column, v: Column = value) -> Column:
        return F.array_join(_cipher(F.split(v, ""), first, last, seed, _shift), "")

    n = F.length(value)
    zero = F.lit(0)
    mail = shifted(zero, n - F.length(F.substring_index(value, ".", -1)) - 2)
    octets = _cipher(F.split(value, r"\."), zero, F.lit(3), seed,
                     lambda c, by: F.pmod(c.cast("int") + by, F.lit(256)).cast("string"))
    phone = shifted(F.when(n >= 11, 1).otherwise(0), n - 1)
    plain = shifted(F.lit(1), n - 1)
    body = shifted(F.lit(1), n - 2)     # the check digit stands apart
    card = F.when(_luhn(value) % 10 == 0, _let(body.substr(F.lit(1), n - 1), lambda b: F.concat(
        b, F.pmod(-_luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))).otherwise(plain)
    out = F.when(kind == "mail", mail).when(kind == "ip", F.array_join(octets, ".")).when(kind == "phone", phone) \
        .when(kind == "card", card).when(kind == "account", shifted(F.lit(2), n - 1)) \
        .when(kind == "social", shifted(zero, n - 1))
    draw = _digest(*seed, value)
    # When so many forms of the value's own length were taken: one more letter or digit an attempt.
    more = F.sequence(F.lit(1), F.greatest(attempt - KEPT_LENGTH, F.lit(1)))
    digits = F.array_join(F.transform(more, lambda i: _number(_digest(draw, i.cast("string")), 0, 10).cast("string")), "")
    letters = F.translate(digits, "0123456789", "abcdefghij")
    grown = _let(out, lambda o: F.when((attempt <= KEPT_LENGTH) | o.isNull(), o).when(kind == "mail", F.concat(letters, o))
                 .otherwise(F.concat(o, F.when(kind == "ip", ".").otherwise(""), digits)))
    name = F.when(F.lit(False), value)
    for (gender, script), names in GIVEN.items():
        listed = F.array(*map(F.lit, names))
        name = name.when(kind == f"given-{gender}-{script}", _given(listed, draw, script, attempt))
    for script, syllables in SYLLABLES.items():
        both = F.array(*map(F.lit, GIVEN["f", script] + GIVEN["m", script]))
        name = name.when(kind == f"given-n-{script}", _given(both, draw, script, attempt)) \
            .when(kind == f"family-{script}", F.initcap(F.concat(_syllables(script, draw, range(4)),
                                                                 _longer(script, draw, attempt))))
    return F.coalesce(grown, name, value)


def _syllables(script: str, draw: Column, places: range) -> Column:
    listed = F.array(*map(F.lit, SYLLABLES[script]))
    return F.concat(*[F.element_at(listed, _number(draw, p, len(SYLLABLES[script])) + 1) for p in places])


def _longer(script: str, draw: Column, attempt: Column) -> Column:
    """One more syllable every ``LONGER`` attempts, so that free names never run out."""
    listed = F.array(*map(F.lit, SYLLABLES[script]))
    more = F.sequence(F.lit(0), (attempt / LONGER).cast("int"))
    return F.array_join(F.transform(F.slice(more, F.lit(2), F.size(more)), lambda i: F.element_at(
        listed, _number(_digest(draw, i.cast("string")), 0, len(SYLLABLES[script])) + 1)), "")


def _given(names: Column, draw: Column, script: str, attempt: Column) -> Column:
    """A listed name and, as the lists are short, a second part after a hyphen."""
    return F.concat(F.element_at(names, _number(draw, 8, 65536) % F.size(names) + 1), F.lit("-"),
                    F.initcap(F.concat(_syllables(script, draw, range(9, 12)), _longer(script, draw, attempt))))


def _is_name(kind: Column | str) -> Column:
    kind = F.col(kind) if isinstance(kind, str) else kind
    return kind.startswith("given") | kind.startswith("family")


def surrogate_table(values: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` for the distinct (kind, value) rows of ``values``,
    with no surrogate twice in a kind and none that is a value of its kind (given names
    of all genders counting as one).  Surrogates grow with the attempts, so all values
    get one, also where all forms of a value's length are taken or it has nothing to
    shift."""
    done, open_ = None, written(values.distinct().withColumn("attempt", F.lit(0)), "values")
    space = F.regexp_replace("kind", "^given-[fmn]", "given").alias("space")
    every = open_.select(space, F.col("value").alias("surrogate"))
    norm = F.when(_is_name("kind"), F.lower("surrogate")).otherwise(F.col("surrogate")).alias("surrogate")
    while True:
        tried = written(open_.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)),
                        "surrogates")
        free = tried.select("kind", "value", space, norm).join(every, ["space", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select(space, norm), ["space", "surrogate"], "left_anti")
        first = free.groupBy("space", "surrogate").agg(F.min(F.struct("value", "kind")).alias("own")) \
            .select("own.kind", "own.value")
        kept = written(tried.join(first, ["kind", "value"], "left_semi").select("kind", "value", "surrogate"), "settled")
        done = kept if done is None else done.unionByName(kept)
        open_ = written(tried.join(first, ["kind", "value"], "left_anti").select(
            "kind", "value", (F.col("attempt") + 1).alias("attempt")), "values")
        if not open_.limit(1).count():
            return done


def _in_form(kind: Column, form: Column, new: Column) -> Column:
    """The surrogate in the mention's own format."""

    def filled(signs: str) -> Column:
        # Each digit (or capital) of the form gives way to the next of the surrogate.
        return F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(
            c.rlike(f"[{signs}]"),
            new.substr(F.length(F.regexp_replace(form.substr(F.lit(1), i + 1), f"[^{signs}]", "")), F.lit(1)))
            .otherwise(c)), "")

    def fitting(signs: str) -> Column:
        # A surrogate that has grown stands as it is.
        own = F.length(F.regexp_replace(form, f"[^{signs}]", ""))
        return F.when(F.length(new) == own, filled(signs)).otherwise(new)

    cased = F.array_join(F.zip_with(F.split(form, ""), F.split(new, ""),
                                    lambda a, b: F.when(a.rlike("[A-Z]"), F.upper(b)).otherwise(b)), "")
    return F.when(kind == "keep", form).when(kind == "mail", cased).when(kind == "ip", new) \
        .when(kind == "account", fitting("A-Z0-9")) \
        .when(_is_name(kind), F.when(form == F.upper(form), F.upper(new)).otherwise(new)) \
        .otherwise(fitting("0-9"))


def _with_bare_names(found: DataFrame) -> DataFrame:
    """``row, doc_id, gaps, mentions``: the words that are names in some mention are
    mentions by themselves as well; gaps are the texts between all mentions."""
    # The first of a document's parts with a form decides what the form is alone.
    names = F.array_distinct(F.filter(F.flatten("mentions"), lambda p: _is_name(p["kind"])))
    forms = F.transform(F.sort_array(F.array_distinct(F.transform("names", lambda p: F.struct(
        F.length(p["form"]).alias("n"), p["form"].alias("form")))), asc=False), lambda x: x["form"])
    # A form of address that is a name here ("Mr Sra") is one everywhere; the names behind it stand alone.
    address = F.array_join(F.filter(forms, lambda f: f.isin([w for ws in ADDRESS.values() for w in ws])), "|")
    # Forms are letters and hyphens; longer ones come first.
    pattern = F.when(F.size("names") == 0, F.lit(PATTERN)).otherwise(F.concat(
        F.when(address != "", F.concat(F.lit(r"(?<![\p{L}])(?:"), address, F.lit(r")(?!-?[\p{L}])|"))).otherwise(""),
        F.lit(PATTERN + r"|(?<![\p{L}])(?=\p{Lu})(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}])")))

    def parts(mention: Column) -> Column:
        bare = F.get(F.filter("names", lambda p: p["form"] == mention), F.lit(0))
        alone = F.rlike(mention, F.lit(rf"^{_CAPITAL}$"))
        return F.coalesce(F.when(alone, F.when(bare.isNotNull(), F.array(bare))), parts_of(mention))

    ready = found.withColumn("names", names).withColumn("pattern", pattern)
    return written(ready.select("row", "doc_id", F.split("text", F.col("pattern"), -1).alias("gaps"), F.transform(
        F.regexp_extract_all("text", F.col("pattern"), F.lit(0)), parts).alias("mentions")), "names")


def _one_gender(values: DataFrame) -> DataFrame:
    """``kind, value, own``: ``own`` is the kind that the value's surrogate is drawn
    for, a gendered one for given names without gender where there is one."""
    known = values.where(F.col("kind").rlike("^given-[fm]-")).groupBy(
        F.regexp_replace("kind", "^given-[fm]", "given-n").alias("kind"), "value").agg(F.min("kind").alias("own"))
    return written(values.join(known, ["kind", "value"], "left").select(
        "kind", "value", F.coalesce("own", "kind").alias("own")), "kinds")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_entities`` for each row, entities replaced.

    Null texts stay null with no entities, empty ones empty; texts of any length are
    searched whole; equal rows get equal results; rows without doc_id are treated like
    any; other columns are ignored; an empty table gives none.  The same key gives the
    same cipher for any corpus.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    has = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    found = _with_bare_names(written(rows.where(has).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.transform(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), parts_of).alias("mentions")), "mentions"))
    parts = found.select("row", F.posexplode("mentions").alias("at", "parts")) \
        .select("row", "at", F.posexplode("parts").alias("part", "p")) \
        .select("row", "at", "part", "p.kind", "p.value", "p.form")
    kinds = _one_gender(parts.where("kind <> 'keep'").select("kind", "value").distinct())
    drawn = surrogate_table(kinds.select(F.col("own").alias("kind"), "value"), key).withColumnRenamed("kind", "own")
    table = kinds.join(drawn, ["own", "value"]).select("kind", "value", "surrogate")
    new = parts.join(table, ["kind", "value"], "left").select(
        "row", "at", "part", _in_form(F.col("kind"), F.col("form"), F.col("surrogate")).alias("new"))
    whole = new.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "part", "new"))).alias("new"))

    def joined(gaps: Column, news: Column) -> Column:
        # A mention's first word follows its gap, further words a space.
        return F.concat(gaps[0], F.array_join(F.transform(news, lambda x: F.concat(
            F.when(x["part"] > 0, " ").otherwise(F.when(x["at"] > 0, F.get(gaps, x["at"])).otherwise("")), x["new"])), ""),
            F.element_at(gaps, -1))

    replaced = found.join(whole, "row").select("doc_id", joined(F.col("gaps"), F.col("new")).alias("text"),
                                               F.size("mentions").cast("long").alias("n_entities"))
    rest = rows.where(~has).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"))
    return replaced.unionByName(rest)
