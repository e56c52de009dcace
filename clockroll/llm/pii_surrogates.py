"""Operator 2: surrogates for personal data [DataFrame functions only].

Entities (mail addresses, phone, card and social security numbers, IP addresses, bank accounts,
access keys, secrets, person names) are found by one pattern.  Each distinct entity of the
corpus gets a keyed surrogate (SHA-256 of key, kind, entity and attempt) of its own kind and
format: digits stay digits, letters stay letters of their case and script, punctuation, country
codes, key prefixes and top-level domains stay, octets stay octets; given names get given names
of the same gender and script (double names double ones), family names get made-up ones of the same script.

Names are found after a title or a listed given name: a run of capitalised words, however many, on
one line (inner capitals, apostrophes, hyphens, initials and particles included).  Each word of a
run counts as found for the whole text: its bare mentions before and after are replaced too, also
in capitals.  Initials before a found word turn into other letters.

Coreference: mentions that differ only in format (case of a mail address, spacing of a number)
share one canonical form and so one surrogate, shown in each mention's own format, in all
documents.  Distinctness: rounds of collision checks over the table of distinct entities.  A
surrogate that equals another entity's surrogate, or any real entity of its kind, is drawn
again with the next attempt until none collides; the smallest entity keeps a contested one.

Only texts with an entity are joined, by a digest of the text, so copies share the work and ids
play no part; all other rows pass without a shuffle.  The distinct entities are a table that is
joined, never broadcast or collected.

Defined cases: null and empty texts stay as they are; rows with null or repeated ids stay one
row each; an empty table gives an empty result; all columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clockroll.llm.common import free_name, staged

#: Titles and given names that mark a person, by gender and script.
MALE_TITLES = ["Mr", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "госпожа"]
OTHER_TITLES = ["Dr", "Prof"]
MALE = ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Hans", "Klaus", "Pierre", "Jean", "Carlos", "José", "Peter", "Paul", "Daniel", "George", "Juan", "Luis"]
FEMALE = ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Ursula", "Greta", "Marie", "Claire", "Carmen", "Lucía", "Anna", "Emma", "Maria", "Laura", "Julia", "Sophie"]
MALE_CYRILLIC = ["Иван", "Пётр", "Сергей", "Дмитрий", "Алексей"]
FEMALE_CYRILLIC = ["Анна", "Мария", "Елена", "Ольга", "Наталья"]
#: Given names that surrogates are taken from (none of them marks a person above).
NEW_MALE = ["Adrian", "Bruno", "Cedric", "Dorian", "Edgar", "Felix", "Gaston", "Hector", "Igor", "Jasper", "Kilian", "Leander", "Magnus", "Nestor", "Oscar", "Quentin"]
NEW_FEMALE = ["Alma", "Beatrix", "Celeste", "Daphne", "Edith", "Fiona", "Gemma", "Hedda", "Ines", "Judith", "Kira", "Leonie", "Mabel", "Nadine", "Odette", "Paloma"]
NEW_MALE_CYRILLIC = ["Богдан", "Вадим", "Глеб", "Егор", "Захар", "Кирилл", "Лев", "Макар"]
NEW_FEMALE_CYRILLIC = ["Алла", "Вера", "Дарья", "Зоя", "Инна", "Кира", "Лидия", "Нина"]
#: Syllables of made-up family names.
SYLLABLES = ["ba", "den", "fol", "gri", "hau", "jor", "kel", "lin", "mar", "nov", "pel", "ros", "sta", "tor", "vin", "wes"]
SYLLABLES_CYRILLIC = ["ба", "ве", "го", "ду", "жи", "зор", "кел", "лин", "мар", "нов", "пе", "рос", "ста", "тор", "фе", "шу"]

#: Lower-case words inside a family name (they stay), and words that end a run of names.
PARTICLES = ["van", "von", "der", "den", "de", "la", "del", "della", "di", "da", "du", "dos", "das", "el", "al", "bin", "ibn", "ter", "ten", "zu", "zum", "zur", "y"]
NO_NAMES = ["The", "This", "That", "These", "Those", "They", "There", "Then", "When", "And", "But"]

_TITLE = "|".join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
_GIVEN = "|".join(MALE + FEMALE + MALE_CYRILLIC + FEMALE_CYRILLIC)
_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]\d\d|\d{1,2})"
_END = r"""[^\s"'.,;:)\]}>]"""
#: After a colon, which prose has too, a value has at least six characters.
_LABEL = rf"""(?i:password|passwd|pwd|secret|token|api_key|apikey|access_key)["']?\s{{0,2}}(?:=\s{{0,2}}["']?|:\s{{0,2}}["']?(?=[^\s"']{{5,}}{_END}|(?<=["'])[^"'\r\n]{{6}}))"""
#: A labelled value of four characters or more: to the closing quote on its line, or else to white space or a
#: quote, without the marks that end a sentence or bracket.  One class per quantifier: no length overflows the stack.
_VALUE = (r"""(?:(?<=")(?=(?:[^"\\\r\n]|\\.){4})[^\r\n]{4,}?(?<!\\)(?=")|(?<=')(?=(?:[^'\\\r\n]|\\.){4})[^\r\n]{4,}?(?<!\\)(?=')"""
          rf"""|[^\s"']{{3,}}{_END})""")
_BLANK = r"[ \t\x{A0}]"
_LETTER = r"[\p{L}\p{M}]"
#: One word of a name, up to a hyphen before a capital; not the 's of a genitive.
_NAME = (rf"(?!(?:{_TITLE}|{'|'.join(NO_NAMES)})(?![\p{{L}}\p{{M}}'’\-]))\p{{Lu}}(?=['’]?{_LETTER}){_LETTER}*+"
         rf"(?:['’](?!(?:s|ll|ve|re|d|m)(?!{_LETTER})){_LETTER}++)?+(?:[\-‐‑]\p{{Ll}}{_LETTER}*+)?+")
_NAMES = rf"(?:(?:{'|'.join(PARTICLES)}){_BLANK}++|[dl]['’]|\p{{Lu}}\.{_BLANK}*+|\p{{Lu}}{_BLANK}++)*+{_NAME}(?:[\-‐‑]{_NAME})*+"
_RUN = rf"{_NAMES}(?:{_BLANK}++{_NAMES})*+"
#: Titles and the run after them (the run may begin on the next line), or a listed given name and its run.
SPAN = (rf"(?<!{_LETTER})(?=[\p{{Lu}}г])(?:(?:(?:{_TITLE})(?!{_LETTER})(?:\.|(?=\s)){_BLANK}*+(?:\R{_BLANK}*+)?)++{_RUN}"
        rf"|(?:{_GIVEN})(?:[\-‐‑]{_NAME})?+{_BLANK}++{_RUN})")
#: Initials before a name: with points, or one without right after a title or a listed given name.
_INITIALS = rf"(?:(?:\p{{Lu}}\.{_BLANK}*+)++|(?<=(?:{_TITLE}|{_GIVEN})\.?\s{{1,4}})\p{{Lu}}{_BLANK}++)"
_HEX, _HEXTET = r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)", r"[0-9A-Fa-f]{1,4}"
#: Kind -> pattern.  The first group is tried where no ASCII letter or digit precedes, the second
#: at the start of a run of digits.
PATTERNS = {
    # at most 64 characters before the sign and 127 labels, as in any address
    "mail": r"[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+\-]{0,63}@(?:[\p{L}\p{M}\p{N}\-]{1,63}\.){1,127}\p{L}{2,24}",
    "key": r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|(?:ghp_|gho_|sk-|xoxb-)[A-Za-z0-9_\-]{16,}+|eyJ[A-Za-z0-9_\-]{5,}+\.[A-Za-z0-9_\-]++(?:\.[A-Za-z0-9_\-]++)?+",
    "secret": rf"{_LABEL}{_VALUE}|{_HEX}(?![A-Za-z0-9])",
    "iban": r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}| [A-Z0-9]{4}(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "phone": r"\+\d{1,3}[ .\-]?\(?\d{1,4}\)?(?:[ .\-]?\d{2,4}){1,4}(?!\d)|\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)",
    "ip6": rf"(?=[0-9A-Fa-f:]{{0,39}}?\d)(?:(?:{_HEXTET}:){{7}}{_HEXTET}|(?:{_HEXTET}:){{1,6}}(?::{_HEXTET}){{1,6}}|(?:{_HEXTET}:){{1,7}}:)(?![A-Za-z0-9:])",
    "ip": rf"(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "local": r"\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])|0\d{2,4}[ /\-]\d{5,8}(?![\d\-])",
    "card": r"\d{13,19}(?![\d\-])|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}(?![\d\-])|\d{4}[ \-]\d{6}[ \-]\d{5}(?![\d\-])",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\d\-])|\d{3} \d{2} \d{4}(?![\d\-])",
}


def _any(*kinds: str) -> str:
    return "(?:" + "|".join(PATTERNS[k] for k in kinds) + ")"


PATTERN = (rf"(?<![A-Za-z0-9])(?=[\p{{L}}\p{{N}}+(]){_any('mail', 'key', 'secret', 'iban', 'phone', 'ip6')}"
           rf"|(?<![\d.\-])(?=\d){_any('ip', 'local', 'card', 'ssn')}")
#: Texts without any of these have no entity.
HINTS = (r"[0-9@=:]|AKIA|ASIA|gh[po]_|sk-|xoxb-|eyJ|[a-f]{32}|[A-F]{32}", rf"(?<!\p{{L}})(?=\p{{Lu}}|г)(?:{_TITLE}|{_GIVEN})(?!{_LETTER})")
#: Kinds whose mentions may differ in punctuation only.
NUMBERS = ("phone", "card", "ssn")
#: Kinds whose mentions may differ in case and initials.
PERSONS = ("male", "female", "family")
KEY = "surrogates-1"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once and once in the plan, however often ``use`` names it: plans, which the
    driver optimizes, compiles and prints, stay as small as the code."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def names_of(text: Column) -> Column:
    """The words of all names in a text, longest first, each also in capitals."""
    spans = F.regexp_extract_all(text, F.lit(SPAN), F.lit(0))
    double = rf"(?<!{_LETTER})(?:{_GIVEN})(?:[\-‐‑]{_NAME})++"  # a given name as a whole, so that its gender stays

    def each(spans: Column, pattern: str) -> Column:
        return F.flatten(F.transform(spans, lambda s: F.regexp_extract_all(s, F.lit(pattern), F.lit(0))))

    def listed(some: Column) -> Column:
        return F.reverse(F.transform(F.array_sort(F.array_distinct(F.transform(F.concat(some, F.transform(some, F.upper)), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))), lambda x: x["w"]))
    words = once(spans, lambda s: F.concat(each(s, rf"(?<!{_LETTER}){_NAME}"), each(s, double)))
    both = once(words, lambda ws: F.concat(ws, F.transform(ws, lambda w: F.regexp_replace(w, rf"[\-‐‑].*$", ""))))
    return once(F.filter(both, lambda w: F.length(w) > 1), listed)


def pattern_of(names: Column) -> Column:
    """The pattern of all entities of a text in which ``names`` were found."""
    bare = F.concat(F.lit(rf"{PATTERN}|(?<!{_LETTER})(?=\p{{Lu}})(?:{_INITIALS})?+(?:"), F.array_join(names, "|"), F.lit(rf")(?!{_LETTER})"))
    return F.when(F.size(names) > 0, bare).otherwise(PATTERN)


def is_name(mention: Column) -> Column:
    return mention.rlike(rf"^(?:\p{{Lu}}(?:\.{_BLANK}*+|{_BLANK}++))*+\p{{Lu}}[\p{{L}}\p{{M}}'’‐‑\-]+$")


def value_of(mention: Column) -> Column:
    """A mention without the label of a secret or the initials of a name."""
    return F.when(is_name(mention), F.regexp_extract(mention, r"[\p{L}\p{M}'’‐‑\-]+$", 0)).otherwise(F.regexp_replace(mention, rf"^{_LABEL}", ""))


def kind_of(mention: Column) -> Column:
    """The kind of a mention: the one whose pattern describes all of its value."""
    def named(value: Column) -> Column:
        given = F.initcap(F.regexp_extract(value, r"^[^\-‐‑]+", 0))  # the first of a double name
        return once(given, lambda g: F.when(g.isin(MALE + MALE_CYRILLIC), "male").when(g.isin(FEMALE + FEMALE_CYRILLIC), "female").otherwise("family"))

    def kind(value: Column) -> Column:
        def is_(kind: str) -> Column:
            return value.rlike(rf"^{_any(kind)}$")
        return (F.when(is_("mail"), "mail").when(is_("key"), "key").when(value.rlike(rf"^{_HEX}$"), "secret").when(is_("iban"), "iban")
                .when(is_("ip6"), "ip6").when(is_("ip"), "ip").when(is_("phone") | is_("local"), "phone").when(is_("card"), "card").when(is_("ssn"), "ssn")
                .when(is_name(mention), named(value)).otherwise("secret"))
    return once(value_of(mention), kind)


def canonical(kind: Column, value: Column) -> Column:
    """What mentions of one entity have in common."""
    return F.when(kind.isin("mail", "ip6"), F.lower(value)).when(kind == "iban", F.replace(value, F.lit(" "))).when(kind.isin(*NUMBERS), F.regexp_replace(value, r"\D", "")).when(kind.isin(*PERSONS), F.initcap(value)).otherwise(value)


def _draw(*parts: Column) -> Column:
    """A keyed number from 0 to 2^32 - 1."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]), 256), 1, 8), 16, 10).cast("long")


def _pick(choices: list[str], n: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in choices]), F.pmod(n, F.lit(len(choices))).cast("int"))


def candidate(kind: Column, entity: Column, attempt: Column, key: str, syllables: int = 2) -> Column:
    """The surrogate of a canonical entity at one attempt; made-up names have ``syllables`` at first."""
    def draw(i: Column) -> Column:
        return _draw(F.lit(key), kind, entity, attempt, i)

    def letter(alphabet: str, i: Column) -> Column:
        return F.substr(F.lit(alphabet), F.pmod(draw(i), F.lit(len(alphabet))).cast("int") + 1, F.lit(1))

    # From the fifth attempt on, forms with few alternatives are widened so that a free one exists:
    # octets of any length, longer mail names, letters for the punctuation of secrets.
    wide = attempt >= 4
    cyrillic = "абвгдежзиклмнопрстуфхцчшщэюя"
    hexed, upper_hexed = entity.rlike(r"^[0-9a-f:]+$"), entity.rlike(r"^[0-9A-F]+$") & (kind == "secret")
    n = F.length(entity)
    # Places that stay: country codes, prefixes of keys, the top-level domain.
    head = F.when(kind == "key", F.length(F.regexp_extract(entity, r"^(?:AKIA|ASIA|ghp_|gho_|sk-|xoxb-|eyJ)", 0))).when(kind == "iban", 2).otherwise(0)
    tail = F.when(kind == "mail", F.length(F.regexp_extract(entity, r"\.\p{L}+$", 0))).otherwise(0)

    def swapped(c: Column, i: Column) -> Column:
        low, up = c.rlike("[a-z]"), c.rlike("[A-Z]")
        return (F.when((i < head) | (i >= n - tail), c).when(c.rlike("[0-9]"), letter("0123456789", i))
                .when(low & hexed, letter("abcdef", i)).when(up & upper_hexed, letter("ABCDEF", i)).when(low, letter("abcdefghijklmnopqrstuvwxyz", i)).when(up, letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i))
                .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), F.upper(letter(cyrillic, i))).when(c.rlike(r"\p{IsCyrillic}"), letter(cyrillic, i))
                .when(c.rlike(r"\p{N}"), letter("0123456789", i)).when(c.rlike(r"\p{Lu}"), letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i)).when(c.rlike(r"\p{L}"), letter("abcdefghijklmnopqrstuvwxyz", i))
                .when(wide & (kind == "secret"), letter("abcdefghijklmnopqrstuvwxyz", i)).otherwise(c))

    chars = F.array_join(F.transform(F.split(entity, ""), swapped), "")
    longer = F.array_join(F.transform(F.sequence(F.lit(1000), F.lit(1007)), lambda i: letter("abcdefghijklmnopqrstuvwxyz", i)), "")
    chars = F.when(wide & (kind == "mail"), F.concat(longer, chars)).otherwise(chars)
    octets = F.array_join(F.transform(F.split(entity, r"\."), lambda o, i: F.when(wide, (1 + F.pmod(draw(i), F.lit(254))).cast("string")).when(F.length(o) == 1, 1 + F.pmod(draw(i), F.lit(9))).when(F.length(o) == 2, 10 + F.pmod(draw(i), F.lit(90))).otherwise(100 + F.pmod(draw(i), F.lit(155))).cast("string")), ".")
    script = entity.rlike(r"\p{IsCyrillic}")
    # Given names: a keyed start, then one place further with each attempt; family names grow.
    def given(latin: list[str], other: list[str]) -> Column:
        def one(*more: Column) -> Column:
            n = _draw(F.lit(key), kind, entity, *more) + attempt
            return F.when(script, _pick(other, n)).otherwise(_pick(latin, n))
        return F.when(entity.rlike(r"[\-‐‑]"), F.concat(one(), F.lit("-"), one(attempt))).otherwise(one())

    parts = F.sequence(F.lit(1), syllables + F.floor(attempt / 3).cast("int"))
    family = F.initcap(F.array_join(F.transform(parts, lambda i: F.when(script, _pick(SYLLABLES_CYRILLIC, draw(i))).otherwise(_pick(SYLLABLES, draw(i)))), ""))
    return (F.when(kind == "ip", octets).when(kind == "male", given(NEW_MALE, NEW_MALE_CYRILLIC)).when(kind == "female", given(NEW_FEMALE, NEW_FEMALE_CYRILLIC))
            .when(kind == "family", family).otherwise(chars))


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``entities`` (kind, entity; distinct) with ``surrogate``: no two alike within a kind, none equal
    to an entity of the kind."""
    entities = staged(entities.select("kind", "entity"), "pii-entities")
    pending, settled, attempt = entities, None, 0
    # So many syllables that there are sixteen made-up names for each real one, whatever the corpus.
    n_names = entities.where("kind = 'family'").count()
    syllables = max(2, 1 + (n_names.bit_length() + 3) // 4)
    while True:
        drawn = pending.withColumn("surrogate", candidate(F.col("kind"), F.col("entity"), F.lit(attempt), key, syllables))
        real = entities.select("kind", F.col("entity").alias("surrogate"))
        first = F.row_number().over(W.partitionBy("kind", "surrogate").orderBy("entity"))
        clear = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            clear = clear.join(settled, ["kind", "surrogate"], "left_anti")
        clear = staged(clear.withColumn("_k", first).where("_k = 1").select("kind", "entity", "surrogate"), "pii-round")
        pending = staged(pending.join(clear, ["kind", "entity"], "left_anti"), "pii-pending")
        settled = clear if settled is None else settled.unionByName(clear)
        if pending.isEmpty():
            return settled
        attempt += 1


def shown(kind: Column, mention: Column, surrogate: Column, key: str = KEY) -> Column:
    """The surrogate in the mention's format."""
    # Initials move through the alphabet by a keyed step of the name, so two never become one.
    def initial(c: Column) -> Column:
        def moved(alphabet: str) -> Column:
            step = 1 + F.pmod(_draw(F.lit(key), F.lit("initial"), surrogate), F.lit(len(alphabet) - 1))
            return F.substr(F.lit(alphabet), F.pmod(F.instr(F.lit(alphabet), c) - 1 + step, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))
        return F.when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), moved("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ")).when(c.rlike(r"\p{Lu}"), moved("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)

    stem = value_of(mention)
    before = F.array_join(F.transform(F.split(F.substr(mention, F.lit(1), F.length(mention) - F.length(stem)), ""), initial), "")
    person = F.concat(before, F.when(F.upper(stem) == stem, F.upper(surrogate)).otherwise(surrogate))

    def char(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), r"\D", ""))
        return F.when(c.rlike(r"\d"), F.substr(surrogate, nth, F.lit(1))).otherwise(c)

    digits = F.array_join(F.transform(F.split(mention, ""), char), "")
    def laid(c: Column, i: Column) -> Column:
        return F.when(c == " ", c).otherwise(F.substr(surrogate, F.length(F.replace(F.substr(mention, F.lit(1), i + 1), F.lit(" "))), F.lit(1)))

    spaced = F.array_join(F.transform(F.split(mention, ""), laid), "")
    country = F.length(F.regexp_extract(mention, r"^\+\d{1,3}(?=[ .\-(])", 0))
    mail = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substr(surrogate, i + 1, F.lit(1)))).otherwise(F.substr(surrogate, i + 1, F.lit(1)))), "")
    return (F.when(kind == "phone", F.concat(F.substr(mention, F.lit(1), country), F.substr(digits, country + 1, F.length(mention))))
            .when(kind.isin(*PERSONS), person).when(kind.isin(*NUMBERS), digits).when(kind == "iban", spaced).when(kind.isin("mail", "ip6") & (F.length(mention) == F.length(surrogate)), mail)
            .otherwise(F.concat(F.regexp_extract(mention, rf"^{_LABEL}", 0), surrogate)))


def replaced(df: DataFrame, text_col: str = "text", key: str = KEY, count_col: str = "n_entities") -> DataFrame:
    """``df`` with every entity of ``text_col`` replaced, and the number of them in ``count_col``
    (with leading underscores if ``df`` has such a column)."""
    cols = df.columns
    found, digest, count, pattern = free_name(cols, "_found"), free_name(cols, "_digest"), free_name(cols, count_col), free_name(cols, "_pattern")
    text = F.col(f"`{text_col}`")
    whole = [F.col(f"`{c}`") for c in cols]
    # A text without names has the one pattern of all; only then the compiled form is used again.
    named = F.when(text.rlike(HINTS[1]), names_of(text))
    src = df.withColumn(pattern, once(named, lambda names: F.when(F.size(names) > 0, pattern_of(names))))
    mine = F.col(pattern)
    none = F.array().cast("array<string>")
    found_all = once(mine, lambda own: F.when(own.isNotNull(), F.regexp_extract_all(text, own, F.lit(0))).when(text.rlike(HINTS[0]), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))))
    src = src.withColumn(found, F.coalesce(found_all, none))
    has = F.size(F.col(found)) > 0
    marked = src.where(has).withColumn(digest, F.sha2(text, 256))
    # Once per distinct text: its mentions in order.
    mentions = marked.select(F.col(digest).alias("digest"), F.col(found).alias("found")).dropDuplicates(["digest"]).select("digest", F.posexplode("found").alias("at", "mention"))
    mentions = mentions.withColumn("kind", kind_of(F.col("mention")))
    mentions = staged(mentions.withColumn("entity", canonical(F.col("kind"), value_of(F.col("mention")))), "pii-mentions")
    table = surrogates(mentions.select("kind", "entity").distinct(), key)
    new = (mentions.join(table, ["kind", "entity"])
           .select("digest", "at", shown(F.col("kind"), F.col("mention"), F.col("surrogate"), key).alias("new"))
           .groupBy("digest").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda s: s["new"]).alias("new")))
    new = staged(new, "pii-texts")
    pieces = once(mine, lambda own: F.when(own.isNotNull(), F.split(text, own, -1)).otherwise(F.split(text, F.lit(PATTERN), -1)))
    rebuilt = F.array_join(F.zip_with(pieces, F.concat(F.col("new"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    done = marked.join(new, marked[digest] == new["digest"]).select(*[rebuilt.alias(c) if c == text_col else F.col(f"`{c}`") for c in cols], F.size(F.col(found)).alias(count))
    return src.where(~has).select(*whole, F.lit(0).alias(count)).unionByName(done)
