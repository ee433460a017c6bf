"""DataFrame operators: segmentation, corpus, generation, validation, sampling, reports."""
