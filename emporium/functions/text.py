"""Text column functions (X2–X5): all native expressions, no UDF."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
# Token pattern: letters a–z, A–Z and the closed Latin-1 ranges á–ú / Á–Ú, 3 or more.
TOKEN_PATTERN = "[a-zA-Zá-úÁ-Ú]{3,}"
# Accent stripping over the lower-case range á–ú (NFKD minus combining marks);
# æ ð ÷ ø have no decomposition and stay as they are.
ACCENTED = "áâãäåçèéêëìíîïñòóôõöùú"
UNACCENTED = "aaaaaceeeeiiiinooooouu"
# Brazilian-Portuguese stop words plus domain-generic words.
PT_STOPWORDS = [
    "a", "o", "as", "os", "um", "uma", "uns", "umas", "de", "do", "da", "dos", "das",
    "em", "no", "na", "nos", "nas", "por", "pra", "para", "com", "sem", "sob", "sobre",
    "e", "ou", "mas", "que", "se", "porque", "como", "quando", "onde", "qual", "quais",
    "eu", "tu", "ele", "ela", "nos", "vos", "eles", "elas", "voce", "voces", "meu", "minha",
    "seu", "sua", "este", "esta", "isso", "esse", "essa", "aquele", "aquela", "ao", "aos",
    "nao", "sim", "ja", "ainda", "muito", "muita", "muitos", "muitas", "mais", "menos",
    "bem", "mal", "tudo", "nada", "algum", "alguma", "todo", "toda", "todos", "todas",
    "ser", "estar", "ter", "fazer", "foi", "era", "esta", "estao", "sao", "tem", "tinha",
    "ficou", "chegou", "veio", "vou", "vai", "so", "ate", "depois", "antes", "agora",
    "comprei", "produto", "produtos", "compra", "loja", "entrega", "recebi", "recebido",
    "pedido", "item", "itens", "dia", "dias", "prazo", "data",
]
# Our own short general-English list (the original used a third-party list).
EN_STOPWORDS = [
    "the", "and", "for", "are", "but", "not", "you", "all", "any", "can", "had", "her",
    "was", "one", "our", "out", "has", "him", "his", "how", "its", "may", "who", "did",
    "yet", "she", "they", "them", "their", "there", "then", "than", "that", "this", "these",
    "those", "with", "from", "have", "into", "onto", "over", "such", "very", "what", "when",
    "where", "which", "while", "would", "could", "should", "about", "after", "again",
    "also", "been", "being", "both", "each", "just", "more", "most", "only", "other",
    "same", "some", "your", "were", "will", "because", "before", "between", "does", "doing",
    "down", "during", "few", "further", "here", "itself", "myself", "nor", "off", "once",
    "own", "too", "under", "until", "why", "whom", "ours", "yours", "theirs", "hers",
]
STOPWORDS = sorted(set(PT_STOPWORDS) | set(EN_STOPWORDS))
# Bands for low vs high score vocabularies.
SCORE_BANDS = {"low (1-2)": [1, 2], "high (4-5)": [4, 5]}


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Whitespace-only → NULL (whitespace trimmed on both ends)."""
    t = F.regexp_replace(_c(c), r"^\s+|\s+$", "")
    return F.nullif(t, F.lit(""))


def text_field(title, message, field: str = "both") -> Column:
    """Title / message / both joined by a space; blank → NULL."""
    if field == "title":
        return blank_to_null(title)
    if field == "message":
        return blank_to_null(message)
    joined = F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "), F.coalesce(_c(message), F.lit("")))
    return blank_to_null(joined)


def strip_accents(c) -> Column:
    """Accent stripping on the closed range á–ú (exact for X4 tokens)."""
    return F.translate(_c(c), ACCENTED, UNACCENTED)


def plain_tokens(c) -> Column:
    """Lower-case, regex tokens of length ≥ 3, accents as they are."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_PATTERN), 0)


def raw_tokens(c) -> Column:
    """X4 first half: lower-case, regex tokens of length ≥ 3, accents stripped."""
    return F.transform(plain_tokens(c), strip_accents)
