"""Text expressions: instructions, lyric sections, prompts, sentence splitting, file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: markers, patterns and prompt text ---------------------------------------
START_OF_SEGMENT = "[start_of_segment]"
END_OF_SEGMENT = "[end_of_segment]"
START_OF_REFERENCE = "[start_of_reference]"
END_OF_REFERENCE = "[end_of_reference]"
MARKERS = (START_OF_SEGMENT, END_OF_SEGMENT, START_OF_REFERENCE, END_OF_REFERENCE)
LYRICS_INSTRUCTION = "Generate music from the given lyrics segment by segment."
AUDIO_EXTENSIONS = (".mp3", ".wav", ".flac")
# ---- end of fixed values -------------------------------------------------------------------

# A section runs from "[tag]" to the next "[" or the very end of the text. Word characters are
# spelled out so that non-Latin tags count in every regex engine alike.
_SECTION = r"(?s)\[([\p{L}\p{N}_]+)\](.*?)(?=\[|\z)"


def strip(text: Column) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def with_instruction(text: Column, instruction: str) -> Column:
    return F.concat_ws("\n", F.lit(instruction), text)


def hash_bits(seed: int, *keys: Column, salt: str = "") -> Column:
    """60 uniform bits from a seed and row keys: equal on every engine, task and retry."""
    text = F.concat_ws(":", F.lit(f"{seed}{salt}"), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_uniform(seed: int, *keys: Column, salt: str = "") -> Column:
    """A deterministic draw from [0, 1) per row."""
    return hash_bits(seed, *keys, salt=salt).cast("double") / float(1 << 60)


def instruction_dropout(
    text: Column, instruction: str, rate: float, seed: int, *keys: Column
) -> Column:
    """Instruction plus text, with the instruction left out for a ``rate`` share of rows."""
    if rate <= 0.0:
        return with_instruction(text, instruction)
    return F.when(hash_uniform(seed, *keys, salt="instruction") < rate, text).otherwise(
        with_instruction(text, instruction)
    )


def header_text(instruction: str, genres: Column, lines: Column) -> Column:
    """``instruction \\n [Genre] genres \\n all lyric lines``."""
    return F.concat_ws(
        "\n", F.lit(instruction), F.concat(F.lit("[Genre] "), genres), F.array_join(lines, "\n")
    )


def split_sections(lyrics: Column) -> Column:
    """Lyric sections rendered as ``[tag]\\nbody\\n\\n``."""
    tags = F.regexp_extract_all(lyrics, F.lit(_SECTION), F.lit(1))
    bodies = F.regexp_extract_all(lyrics, F.lit(_SECTION), F.lit(2))
    return F.zip_with(
        tags, bodies, lambda t, b: F.concat(F.lit("["), t, F.lit("]\n"), strip(b), F.lit("\n\n"))
    )


def build_prompts(genres: Column, sections: Column) -> Column:
    """Header prompt followed by one prompt per section, without segment markers."""
    head = F.concat_ws(
        "\n",
        F.lit(LYRICS_INSTRUCTION),
        F.concat(F.lit("[Genre] "), strip(genres)),
        F.array_join(sections, "\n"),
    )
    return F.transform(
        F.concat(F.array(head), sections),
        lambda p: F.replace(F.replace(p, F.lit(START_OF_SEGMENT), F.lit("")), F.lit(END_OF_SEGMENT), F.lit("")),
    )


def limit_sections(prompts: Column, sections: Column, n: int) -> Column:
    """The prompts one run uses: ``min(n + 1, number of sections)``."""
    return F.slice(prompts, F.lit(1), F.least(F.lit(n + 1), F.size(sections)))


def split_sentences(text: Column, enabled: bool = True, keep_newlines: bool = False) -> Column:
    """Sentences of a text, cut after ``. ! ?``.

    ``enabled=False`` keeps the whole text as the only sentence. With ``keep_newlines`` the
    white space stays with the following sentence, so joining the result gives the text back.
    """
    if not enabled:
        return F.array(text)
    cut = r"(?<=[.!?])(?=[ \t\n\r\f])" if keep_newlines else r"(?<=[.!?])[ \t\n\r\f]+"
    return F.filter(F.split(text, cut), lambda s: F.length(s) > 0)


def extension(name: Column) -> Column:
    """Lower-case file extension with its dot, or an empty string."""
    return F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))


def has_extension(name: Column, extensions) -> Column:
    return extension(name).isin([e.lower() for e in extensions])


def stem(name: Column) -> Column:
    """File name without folder and last extension."""
    return F.regexp_replace(F.regexp_replace(name, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")


def without_extension(path: Column) -> Column:
    """Path without its last extension (folders kept)."""
    return F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", "")


def track_key(name: Column) -> Column:
    return F.substring_index(stem(name), ".", 1)


def track_type(name: Column) -> Column:
    base = F.lower(stem(name))
    return (
        F.when(base.contains("vocal"), "Vocals")
        .when(base.contains("inst"), "Instrumental")
        .otherwise("Full")
    )


def track_name(key: Column, kind: Column, segment: Column | None = None) -> Column:
    """``key.Type`` (or ``key`` for a full mix), plus ``.segN`` for a numbered segment."""
    name = F.when(kind == "Full", key).otherwise(F.concat_ws(".", key, kind))
    return name if segment is None else F.concat(name, F.lit(".seg"), segment.cast("string"))


def specials_pattern(specials) -> str:
    """Alternation of escaped special tokens, in the given order."""
    return "(" + "|".join(re.sub(r"([\\\[\](){}.*+?^$|])", r"\\\1", s) for s in specials) + ")"
