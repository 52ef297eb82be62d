"""layerwise: labelled-table preparation, layered-model scoring, parameter-averaging
training and evaluation, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
