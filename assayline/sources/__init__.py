"""Tables in and out: medallion layers, Bronze metadata, literal tables."""
