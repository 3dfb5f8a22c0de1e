from surgeflow.streaming.job import start_message_rate, start_stream
from surgeflow.streaming.micro_batch import BatchProcessor, process_batch

__all__ = ["BatchProcessor", "process_batch", "start_message_rate", "start_stream"]
