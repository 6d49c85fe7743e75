"""Gates: hallucinated or foreign transcripts, and score filters with explicit reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarin.functions import scores
from tamarin.functions.text import bind, strip

#: Phrases a recogniser invents.
HALLUCINATIONS = (
    r"sous[- ]titr", r"amara\.org", r"abonnez[- ]vous", r"merci d'avoir regard", r"^\s*merci\s*\.?\s*$", r"c'est la fin de la vid",
    r"like et abonne", r"^\s*musique\s*\.?\s*$", r"^\s*\.{2,}\s*$", r"transcription par",
)
#: Creole function words, compared without accents.
CREOLE_WORDS = (
    "ka", "an", "sé", "se", "on", "té", "te", "yo", "pa", "ou", "ki", "pou",
    "adan", "kon", "sa", "vou", "moun", "fè", "ni", "la", "mwen", "nou", "ay",
    "dèyè", "asi", "zot", "i", "ba", "kè", "ké", "apa", "poko", "toujou", "yon",
    "nan", "li", "gen",
)
#: French function words.
FRENCH = (
    "est", "les", "que", "pour", "dans", "je", "vous", "nous", "avec", "mais",
    "plus", "cette", "comme", "tout", "être", "sont", "fait", "bien", "peut",
    "même", "très", "leur", "elle", "des", "une", "aux", "par", "sur", "son",
    "ses", "qui", "au", "du", "il", "ce", "donc", "alors", "parce", "toujours",
    "aussi", "chose", "faire",
)
#: Letters of a word, and their plain forms.
WORD = "([a-zàâäéèêëîïôöùûüçòñ']+)"
ACCENTED, PLAIN = "àâäéèêëîïôöùûüçòñ", "aaaeeeeiioouuucon"
#: The creole words as they are compared, without accents.
CREOLE = tuple(dict.fromkeys(w.translate(str.maketrans(ACCENTED, PLAIN)) for w in CREOLE_WORDS))


def rejection(text: Column) -> Column:
    """Null where a transcript is kept, else ``hallucination`` or ``français``. Blank and doubtful texts are kept: fewer than three
    words, or no strict majority of French function words."""
    t = strip(F.coalesce(text, F.lit("")))
    creole = F.array(*map(F.lit, CREOLE))
    french = F.array(*map(F.lit, FRENCH))

    def judged(x: Column) -> Column:
        k = F.size(F.filter(x.words, lambda w: F.array_contains(creole, F.translate(w, ACCENTED, PLAIN))))
        f = F.size(F.filter(x.words, lambda w: F.array_contains(french, w)))
        invented = F.rlike(x.t, F.lit("(?i)" + "|".join(HALLUCINATIONS)))
        return F.when(x.t == "", None).when(invented, "hallucination").when((F.size(x.words) >= 3) & (f > k), "français")

    return bind(F.struct(t.alias("t"), F.regexp_extract_all(F.lower(t), F.lit(WORD), 1).alias("words")), judged)


def reasons(logprob: Column, compression: Column, ppl: Column, no_speech: Column, n_tokens: Column, ppl_threshold: float = scores.MAX_PERPLEXITY) -> Column:
    """Reasons to reject a segment, in fixed order; a missing score never rejects."""
    return F.array_compact(
        F.array(
            F.when(logprob < scores.MIN_LOGPROB, f"logprob<{scores.MIN_LOGPROB}"),
            F.when(compression > scores.MAX_COMPRESSION, f"compression>{scores.MAX_COMPRESSION}"),
            F.when(ppl > ppl_threshold, f"ppl>{ppl_threshold:.0f}"),
            F.when(no_speech > scores.MAX_NO_SPEECH, f"no_speech>{scores.MAX_NO_SPEECH}"),
            F.when(n_tokens < scores.MIN_TOKENS, "trop_court"),
        )
    )


def histogram(df: DataFrame, array: str, *by: str) -> DataFrame:
    """Rows per element of an array column: ``by..., value, n``."""
    return df.select(*by, F.explode(array).alias("value")).groupBy(*by, "value").agg(F.count("*").alias("n"))
