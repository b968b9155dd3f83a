"""Reports, workloads, the monthly load and the end-to-end job."""
