"""Shared vocabulary layout and the arithmetic between codec matrices and vocabulary ids.

A codec matrix is ``ARRAY<ARRAY<INT>>``: the outer array has one entry per codebook (K), each
inner array one code per frame (T). Ids live in one vocabulary of 83,734 entries: text,
then special tokens, then one id range per codec.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let, let_all

# ---- fixed values: vocabulary layout -------------------------------------------------------
SPECIAL_TOKENS = {
    "<EOD>": 32000,
    "<SOA>": 32001,
    "<EOA>": 32002,
    "<SOI>": 32003,
    "<EOI>": 32004,
    "<SOV>": 32005,
    "<EOV>": 32006,
    "<s_local>": 32007,
    "<e_local>": 32008,
    "<s_global>": 32009,
    "<e_global>": 32010,
    "<semantic>": 32011,
    "<acoustic>": 32012,
    "<stage_1>": 32013,
    "<dac_16k>": 32014,
    "<dac_44k>": 32015,
    "<xcodec>": 32016,
    "<stage_2>": 32017,
    "<semantic_mert>": 32018,
    "<semantic_hubert>": 32019,
    "<visual>": 32020,
    "<semanticodec>": 32021,
}
TEXT_VOCAB_SIZE = 32000
VOCAB_SIZE = 83734

EOD = SPECIAL_TOKENS["<EOD>"]
SOA = SPECIAL_TOKENS["<SOA>"]
EOA = SPECIAL_TOKENS["<EOA>"]
STAGE_1 = SPECIAL_TOKENS["<stage_1>"]
STAGE_2 = SPECIAL_TOKENS["<stage_2>"]


@dataclass(frozen=True)
class Codec:
    """One audio codec: sizes of its codebooks and where its ids start."""

    name: str
    sizes: tuple[int, ...]
    global_offset: int
    separators: tuple[str, ...]
    fps: int | None = None

    @property
    def num_codebooks(self) -> int:
        return len(self.sizes)

    @property
    def separator_ids(self) -> list[int]:
        return [SPECIAL_TOKENS[s] for s in self.separators]

    def base(self, layer: int) -> int:
        """First id of codebook ``layer``: all earlier codebooks lie before it."""
        return self.global_offset + sum(self.sizes[:layer])

    @property
    def id_range(self) -> tuple[int, int]:
        return self.global_offset, self.base(self.num_codebooks) - 1


# Order matters: an id range is attributed to the first codec that contains it.
CODECS = {
    c.name: c
    for c in (
        Codec("dac16k", (1024,) * 4, 32022, ("<dac_16k>",), 50),
        Codec("dac44k", (1024,) * 9, 36118, ("<dac_44k>",)),
        Codec("xcodec", (1024,) * 12, 45334, ("<xcodec>",), 50),
        Codec("mert", (1024,), 57622, ("<semantic_mert>",)),
        Codec("hubert", (512,), 58646, ("<semantic_hubert>",)),
        Codec("semantic/s", (16384,), 59158, ("<semanticodec>", "<semantic>")),
        Codec("semantic/a", (8192,), 75542, ("<semanticodec>", "<acoustic>")),
        Codec("semanticodec", (16384, 8192), 59158, ("<semanticodec>",), 50),
    )
}
CODEC_ALIASES = {"xcodec_16k": "xcodec"}
# ---- end of fixed values -------------------------------------------------------------------


def get_codec(name: str) -> Codec:
    return CODECS[CODEC_ALIASES.get(name, name)]


@dataclass(frozen=True)
class CodecOptions:
    """Which codebooks of which codec feature to use."""

    codec: str = "xcodec"
    quantizer_begin: int = 0
    n_quantizer: int | None = None
    teacher_forcing: bool = False
    feature: str = "codec"
    spec: Codec = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "spec", get_codec(self.codec))
        if self.n_quantizer is None:
            object.__setattr__(self, "n_quantizer", self.spec.num_codebooks)
        if self.quantizer_begin + self.n_quantizer > self.spec.num_codebooks:
            raise ValueError(f"{self.codec} has {self.spec.num_codebooks} codebooks")

    @property
    def layers(self) -> range:
        return range(self.quantizer_begin, self.quantizer_begin + self.n_quantizer)

    @property
    def bases(self) -> list[int]:
        return [self.spec.base(k) for k in self.layers]


def int_array(values) -> Column:
    """A literal ``ARRAY<INT>``."""
    return F.expr(f"cast(array({', '.join(str(int(v)) for v in values)}) as array<int>)")


def double_array(values) -> Column:
    """A literal ``ARRAY<DOUBLE>``."""
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def n_frames(matrix: Column) -> Column:
    return F.when(F.size(matrix) > 0, F.size(F.get(matrix, F.lit(0)))).otherwise(F.lit(0))


def _shift_rows(matrix: Column, bases: list[int], sign: int) -> Column:
    shifts = int_array([sign * b for b in bases])
    return F.transform(matrix, lambda row, k: F.transform(row, lambda x: x + F.get(shifts, k)))


def offset_codes(matrix: Column, opts: CodecOptions) -> Column:
    """Codes of the selected codebooks as vocabulary ids, still K x T."""
    rows = F.slice(matrix, opts.quantizer_begin + 1, opts.n_quantizer)
    return _shift_rows(rows, opts.bases, 1)


def unoffset_codes(ids: Column, opts: CodecOptions) -> Column:
    """Inverse of :func:`offset_codes` for a K x T matrix of ids."""
    return _shift_rows(ids, opts.bases, -1)


def flatten_frames(matrix: Column) -> Column:
    """K x T matrix to one list, frame by frame (all codebooks of frame 0, then frame 1, ...)."""

    def flat(m: Column) -> Column:
        k = F.size(m)
        total = k * n_frames(m)
        ids = F.transform(
            F.sequence(F.lit(0), total - 1),
            lambda i: F.get(F.get(m, F.pmod(i, k)), F.floor(i / k).cast("int")),
        )
        return F.when(total > 0, ids).otherwise(F.array().cast("array<int>"))

    return let(matrix, flat)


def unflatten_frames(ids: Column, n_codebooks: int) -> Column:
    """Inverse of :func:`flatten_frames`; the length must be a multiple of ``n_codebooks``."""

    def rows(x: Column) -> Column:
        def layer(k: int) -> Column:
            return F.filter(x, lambda _, i: i % n_codebooks == k)

        whole = F.size(x) % n_codebooks == 0
        return F.when(whole, F.array(*[layer(k) for k in range(n_codebooks)]))

    return let(ids, rows)


def codes_to_ids(matrix: Column, opts: CodecOptions) -> Column:
    """Offset and flatten in one pass over the matrix."""
    bases = int_array(opts.bases)
    n = opts.n_quantizer
    if n == 1:
        row = F.get(matrix, F.lit(opts.quantizer_begin))
        return F.transform(row, lambda x: x + F.lit(opts.bases[0]))

    def flat(m: Column) -> Column:
        total = n_frames(m) * n
        ids = F.transform(
            F.sequence(F.lit(0), total - 1),
            lambda i: F.get(F.get(m, i % n + opts.quantizer_begin), F.floor(i / n).cast("int"))
            + F.get(bases, i % n),
        )
        return F.when(total > 0, ids).otherwise(F.array().cast("array<int>"))

    return let(matrix, flat)


def starts_in_first_codebook(ids: Column, opts: CodecOptions) -> Column:
    """True when the first id belongs to the first selected codebook."""
    low = opts.bases[0]
    high = low + opts.spec.sizes[opts.quantizer_begin]
    first = F.get(ids, F.lit(0))
    return F.coalesce((first >= low) & (first < high), F.lit(False))


def ids_to_codes(ids: Column, opts: CodecOptions) -> Column:
    """Flat ids back to a K x T code matrix; null when the list does not start at codebook 0
    or is not a whole number of frames."""
    return let(
        ids,
        lambda x: F.when(
            starts_in_first_codebook(x, opts),
            unoffset_codes(unflatten_frames(x, opts.n_quantizer), opts),
        ),
    )


def detect_codec(low: Column, high: Column) -> Column:
    """Name of the first codec whose id range holds ``[low, high]`` (eight fixed ranges)."""
    expr = None
    for codec in CODECS.values():
        begin, end = codec.id_range
        hit = (low >= begin) & (high <= end)
        expr = F.when(hit, codec.name) if expr is None else expr.when(hit, codec.name)
    return expr


def codes_problem(matrix: Column, opts: CodecOptions) -> Column:
    """Why a raw code matrix is unusable, or null when it is fine."""
    return let(matrix, lambda m: _codes_problem(m, opts))


def _codes_problem(matrix: Column, opts: CodecOptions) -> Column:
    spec = opts.spec
    k = F.size(matrix)
    sizes = int_array(spec.sizes)
    # Least and greatest codes tell as much as all of them, and are found without a call per code.
    bad_value = F.exists(
        F.transform(
            matrix,
            lambda row, i: (F.array_min(row) < 0) | (F.array_max(row) >= F.coalesce(F.get(sizes, i), F.lit(min(spec.sizes)))),
        ),
        lambda b: b,
    )
    ragged = F.exists(matrix, lambda row: F.size(row) != n_frames(matrix))
    bases = int_array(opts.bases)
    layers = F.slice(matrix, opts.quantizer_begin + 1, opts.n_quantizer)
    if opts.n_quantizer > 1:  # several layers have no ids without a first row, which tells their number of frames
        layers = F.when(n_frames(matrix) > 0, layers)
    low = F.array_min(F.transform(layers, lambda row, i: F.array_min(row) + F.get(bases, i)))
    high = F.array_max(F.transform(layers, lambda row, i: F.array_max(row) + F.get(bases, i)))
    found = let_all(detect_codec, low=low, high=high)
    return (
        F.when(matrix.isNull() | (F.coalesce(k, F.lit(0)) <= 0) | (n_frames(matrix) <= 0), "empty_codes")
        .when(~k.isin(spec.num_codebooks, opts.n_quantizer), "codebook_count")
        .when(k < opts.quantizer_begin + opts.n_quantizer, "codebook_count")
        .when(ragged, "ragged_codes")
        .when(bad_value, "code_out_of_range")
        .when(F.coalesce(found != F.lit(spec.name), F.lit(True)), "codec_range")
    )


def code_diversity(matrix: Column, layer: int = 0) -> Column:
    """Number of distinct codes in one codebook row."""
    return F.size(F.array_distinct(F.get(matrix, F.lit(layer))))


def slice_frames(matrix: Column, start: Column, end: Column) -> Column:
    """Frames ``[start, end)`` of every codebook row."""
    return F.transform(matrix, lambda row: F.slice(row, start + 1, end - start))


def window_codes(matrix: Column, frames: int) -> Column:
    """Consecutive windows of ``frames`` frames; the incomplete tail is dropped."""

    def cut(m: Column) -> Column:
        count = F.floor(n_frames(m) / frames).cast("int")
        windows = F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda w: F.transform(m, lambda row: F.slice(row, w * frames + 1, frames)),
        )
        return F.when(count > 0, windows).otherwise(F.array().cast("array<array<array<int>>>"))

    return let(matrix, cut)
