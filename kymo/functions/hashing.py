"""Reproducible hash values: the 128-bit digest as a number, without UDFs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Resolution of the hash share, and the name of each part.
HASH_STEPS = 10_000
TRAIN, VALID, TEST = "train", "valid", "test"

# Range of digest_position.
DIGEST_RANGE = (0, (1 << 32) - 1)


def string_hash_mod(text: Column, n: int) -> Column:
    """MD5 of the text, read as one hexadecimal integer, modulo ``n``.

    The digest exceeds decimal(38), so the modulus runs over chunks of at most
    fifteen digits, which fit a bigint.
    """
    digest = F.md5(text)
    rest = F.lit(0).cast("bigint")
    for first, digits in ((1, 15), (16, 15), (31, 2)):
        chunk = F.conv(F.substring(digest, first, digits), 16, 10).cast("bigint")
        shift = F.lit(16**digits % n).cast("bigint")
        rest = (rest * shift + chunk % F.lit(n)) % F.lit(n)
    return rest


def hash_share(text: Column) -> Column:
    """Hash of the text as a number in [0, 1) with four digits."""
    return string_hash_mod(text, HASH_STEPS) / F.lit(float(HASH_STEPS))


def string_kfold(ident: Column, n_folds: int = 3, val_ratio: float = 0.2, seed: int = 42) -> Column:
    """Array of one part name per fold; the id is in test in exactly one fold."""
    if n_folds < 1:
        raise ValueError(f"need one fold or more, not {n_folds}")
    if not 0.0 <= val_ratio <= 1.0:
        raise ValueError(f"the validation share is {val_ratio}, outside 0 to 1")
    base = F.concat(ident, F.lit(f"_{seed}"))
    home = string_hash_mod(base, n_folds)
    parts = [
        F.when(home == k, TEST)
        .when(hash_share(F.concat(base, F.lit(f"_{k}"))) < val_ratio, VALID)
        .otherwise(TRAIN)
        for k in range(n_folds)
    ]
    return F.when(F.length(ident) > 0, F.array(*parts))


def hash_three_way(
    ident: Column, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42
) -> Column:
    """One part name per id from its hash share and the cumulative ratios."""
    share = hash_share(F.concat(ident, F.lit(f"_{seed}")))
    return (
        F.when(share < ratios[0], TRAIN).when(share < ratios[0] + ratios[1], VALID).otherwise(TEST)
    )


def shuffle_digest(ident: Column, seed: int | str = 42) -> Column:
    """Digest whose order is the reproducible random order of ids."""
    return F.md5(F.concat(ident.cast("string"), F.lit(f"_{seed}")))


def digest_position(digest: Column) -> Column:
    """Leading 32 bits of a digest: a bigint that rises with the digest's order."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
