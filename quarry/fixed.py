"""Fixed values.

Everything here must equal the behaviour being rebuilt for results to match
(prompt layout, stand-in rows, bounds, fractions, seeds, rounding and fit
settings).  They are stated once, plainly, in the order a pipeline uses them;
operators take them as defaults.
"""

# Prompt layout of the instruction format.
INSTRUCTION_HEADER = "### Instruction:\n"
INPUT_HEADER = "### Input:\n"
RESPONSE_HEADER = "### Response:\n"
SECTION_BREAK = "\n\n"
QUESTION_PREFIX = "Question: "
ANSWER_PREFIX = "\nAnswer: "

# Offline stand-in instruction rows.
DUMMY_INSTRUCTION = "What is the capital of country %d?"
DUMMY_INPUT = ""
DUMMY_OUTPUT = "The capital of country %d is City %d."
DUMMY_MAX_ROWS = 1000

# Token sequence bounds and padding.
MIN_TOKENS = 10  # shortest kept sequence (inclusive)
PADDED_LENGTH = 128  # sentence inputs are padded to this length
PAD_MULTIPLE = 8  # dynamic batch padding rounds up to a multiple of this
IGNORE_INDEX = -100  # label value of padded positions

# Evaluation.
GENERATION_MIN_TOKENS = 20  # only longer sequences get a generation score (strictly greater)
GENERATION_CAP_TOKENS = 50  # score = min(generated / 50, 1)
METRIC_DIGITS = 4  # reports round metrics to 4 decimals

# Sampling and splits.
TEST_SIZE = 0.25  # tabular train/validation split
TABULAR_SEED = 1
SENTENCE_SAMPLE_FRACTION = 0.01
SENTENCE_SEED = 1
SHUFFLE_SEED = 42  # instruction sample and rating permutation
RATING_VAL_FRACTION = 0.2
SEQUENTIAL_TRAIN = 0.8
SEQUENTIAL_VAL = 0.1

# Rating normalisation (1..5 -> 0..1).
RATING_MIN = 1.0
RATING_MAX = 5.0

# Fit settings.
GBT_ROUNDS = 10
GBT_MAX_DEPTH = 5
GBT_STEP_SIZE = 0.1
GBT_FEATURE_FRACTION = 0.3
GBT_L1 = 10.0
MLP_HIDDEN = (64, 32)
MLP_LEARNING_RATE = 1e-3
RECOMMENDER_RANK = 32
RECOMMENDER_HIDDEN = 64
RECOMMENDER_EPOCHS = 3
