"""Operators for preparing training text. Their task functions travel with the job, so executors need no copy."""

import importlib

from pyspark import cloudpickle

for _name in ("columns", "tokens", "quality", "toxicity", "simhash", "topk", "interpolation", "decontamination", "packing", "lexical", "negatives"):
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
