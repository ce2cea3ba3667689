"""Word lists that results depend on."""

from __future__ import annotations

import os
from pathlib import Path

# Stop words that alignment and search leave out, by language code.
STOPWORDS_TEXT = {
    "en": """
    the a an and or but if then so of to in on at for with as by is are was were be been being this that these
    those it its we you i he she they them our your here there now will can do does did have has had not no yes
    about into out up down over just like some any all one two let lets gonna okay ok
    """,
    "tr": """
    acaba ama ancak artık aslında az bazı belki ben beni benim beri bile bir birçok biri birkaç biz bize bizi
    bizim bu buna bunda bundan bunu bunun burada çok çünkü da daha de defa değil diğer diye dolayı en gibi göre
    hangi hani hatta hem henüz hep hepsi her herkes hiç hiçbir için ile ise işte kadar karşın kendi ki kim mı mu
    mü mi nasıl ne neden nerede nereye niye niçin o olarak oldu olduğu olan olur ona ondan onlar onları onların
    onu onun orada öyle pek rağmen sanki şey şu şöyle şimdi siz sizi sizin sonra tüm üzere var ve veya ya yani
    yeni yine yoksa yok
    """,
}

# Language names that recognisers return, and their codes.
LANGUAGE_CODES = {
    "english": "en",
    "turkish": "tr",
    "german": "de",
    "french": "fr",
    "spanish": "es",
    "italian": "it",
    "portuguese": "pt",
    "russian": "ru",
    "arabic": "ar",
}

# Words that make a line with a semicolon look like code.
CODE_KEYWORDS = """
for while do if else switch case return break continue goto int char void float double long short unsigned
signed const static struct union enum typedef sizeof printf scanf malloc free main include
""".split()


#: Names the folder of a user's own languages: a file CODE.txt each, words one to a line, # before a comment.
FOLDER = "CHALKLINE_LANGUAGES"


def _own() -> dict[str, Path]:
    folder = os.environ.get(FOLDER)
    return {p.stem.lower(): p for p in Path(folder).glob("*.txt")} if folder and Path(folder).is_dir() else {}


def stopwords(language: str) -> list[str]:
    """Stop words of a language code in any case, from the user's file if there is one; none for an unknown language."""
    code = language.strip().lower()
    own = _own().get(code)
    if own is None:
        return STOPWORDS_TEXT.get(code, "").split()
    words = (line.partition("#")[0].strip().lower() for line in own.read_text(encoding="utf-8").splitlines())
    return sorted({w for w in words if w})


def languages() -> list[str]:
    """Codes of the languages that have stop words, the user's own among them."""
    return sorted({*STOPWORDS_TEXT, *_own()})
