"""Raw CSV files and arrival notifications."""
