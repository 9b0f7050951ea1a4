"""Post-market device surveillance on Spark: feeds in, integrated devices, recall risk scores, analytics out."""
