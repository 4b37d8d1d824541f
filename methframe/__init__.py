"""methframe: DNA-methylation sequencing analysis as Spark DataFrames."""
