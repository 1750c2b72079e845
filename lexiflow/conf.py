"""Job settings.

Plain frozen dataclasses captured on the driver; their values become literals
in the Spark plan, so nothing depends on static state inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's settings.
SEQ_LEN = 663            # padded sequence length
DEFAULT_CLASSES = ("a", "b")
SPLIT_FRACTION = 0.7     # train share
SPLIT_SEED = 11
BATCH_SIZE = 36
EPOCHS = 10
AVERAGING_FREQUENCY = 5
HIDDEN_SIZE = 256
L2 = 5e-4
NET_SEED = 1234
CHUNK_LEN = 1000
GEN_SAMPLES = 4
GEN_STEPS = 300


@dataclass(frozen=True)
class TextConf:
    """Tokenizer settings: they drive the vocabulary and the encoding of texts
    (``operators.examples``) and the words a model is trained on (T06)."""

    min_count: int = 1                  # words seen less often are unknown
    ngram: int = 1                      # n-grams of words in place of words
    normalize: bool = True              # cleaning and lower case
    use_unknown: bool = True            # unknown words get an id; else they are dropped
    unknown_id: int = 0
    stop_words: tuple[str, ...] = ()
    seq_len: int = SEQ_LEN              # width of encoded examples


@dataclass(frozen=True)
class TrainConf:
    """Classifier settings shared by the training operators."""

    model: str = "counted"              # or "linear"
    classes: tuple[str, ...] = DEFAULT_CLASSES
    train_fraction: float = SPLIT_FRACTION
    seed: int = SPLIT_SEED
    split_key: str = "text"
    epochs: int = EPOCHS
    averaging: int = AVERAGING_FREQUENCY
    batch_size: int = BATCH_SIZE
    hidden: int = HIDDEN_SIZE
    l2: float = L2
    net_seed: int = NET_SEED
    reduction: str = "mean"             # or "last_step" (counted model)
    text: TextConf = field(default_factory=TextConf)


@dataclass(frozen=True)
class CharConf:
    """Character-model settings: they drive chunks, pairs and generation."""

    chunk_len: int = CHUNK_LEN
    keep_tail: bool = True              # False: the loop's bounds, which lose each text's end
    samples: int = GEN_SAMPLES
    steps: int = GEN_STEPS
    seed: int = 12345
