"""Streaming: nothing to build.

The reference declares streaming dependencies but no code uses them: there
is no stream source, watermark, window or state anywhere in it.  Fitted
models from ``minekit.operators`` are ordinary ``spark.ml`` models, so
``model.transform`` already works on a streaming DataFrame if one is needed.
"""
