"""Review analytics as Spark jobs: layers, quality, sampling, aspects, text models, reports."""
