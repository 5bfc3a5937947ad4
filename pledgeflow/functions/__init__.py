"""Column expressions shared by the batch jobs and the stream guards."""
