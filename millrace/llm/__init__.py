"""Operators for preparing training text: ten methods, their queries, and the pipeline's stages.

The functions that run in Python tasks travel with the job, so executors need this package neither
installed nor on their path; they need numpy, pyarrow and the small libraries each module imports.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
