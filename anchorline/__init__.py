"""anchorline: event timelines as DataFrames, and training-data operators in ``anchorline.llm``."""
