"""No operator of this engine reads a stream: its sources are finished books. Resumed batches are in ``operators.run``."""
