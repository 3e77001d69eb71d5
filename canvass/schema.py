"""Column names of the answer stream (EAV in document order).

answers: subject_id, seq, block, element, attribute, value

* ``seq``   LONG, unique per subject, defines document order.
* ``block`` LONG, non-decreasing in ``seq`` within a subject; it bounds how many
  rows of one subject a single window task sees (see ``operators.ordered``).
"""

SUBJECT = "subject_id"
SEQ = "seq"
BLOCK = "block"
ELEMENT = "element"
ATTRIBUTE = "attribute"
VALUE = "value"

STREAM_COLUMNS = [SUBJECT, SEQ, BLOCK, ELEMENT, ATTRIBUTE, VALUE]

# Element names of interview documents (fixed values of the survey XML format).
QUESTION = "FullVariable"
ANSWER = "QuestionAnswer"
GRID_LABEL = "Text"
GRID_ANSWER = "TopicAnswer"
SECTION = "Variable"

# Default span of seq values per block. Positional streams (documents) have
# dense seq, so a block holds at most this many rows of one subject.
DEFAULT_BLOCK_SPAN = 1 << 16
BLOCK_SPAN_CONF = "canvass.stream.blockSpan"
