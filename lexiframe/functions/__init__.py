from lexiframe.functions.text import (  # noqa: F401
    JAVA_TOKEN_PATTERN,
    tokens,
    keyword_terms,
    line_slice,
    shingles,
    with_term_counts,
    normalize_newlines,
)
from lexiframe.functions.stats import (  # noqa: F401
    student_t_two_sided_p,
    normal_cdf,
    sq_euclidean,
)
