"""Edge-case input files (see FIXTURES.md, section 3)."""

ARTISTS_CSV = '''id,followers,genres,name,popularity
a1,100.0,"['pop', 'dance pop']",Ann,50
a2,,[],"Bob ""B"" Ray",
a2,7.0,[],Bob later,9
,5.0,[],No Key,1
a3,16777217,[],Cy,xx
'''

TRACKS_CSV = '''id,name,popularity,duration_ms,explicit,artists,id_artists,release_date,danceability,energy,key,loudness,mode,speechiness,acousticness,instrumentalness,liveness,valence,tempo,time_signature
t1,"One, two",10,1000,0,"['Ann', 'Bob']","['a1', 'a2']",2020-01-02,0.5,0.6,1,-5.0,1,0.1,0.2,0.0,0.3,0.4,120.0,4
t2,Ghost,20,2000,1,['Zed'],['a9'],1999,0.1,0.2,2,-6.0,0,0.1,0.2,0.0,0.3,0.4,90.5,3
t3,Nobody,30,3000,0,[],[],2001-05,0.1,0.2,2,-6.0,0,0.1,0.2,0.0,0.3,0.4,90.5,3
t4,Broken,40,4000,0,[],['a1',2001,0.1,0.2,2,-6.0,0,0.1,0.2,0.0,0.3,0.4,90.5,3
t5,Twice,50,5000,0,"['Ann', 'Ann']","['a1', 'a1']",2002,0.1,0.2,2,-6.0,0,0.1,0.2,0.0,0.3,0.4,90.5,3
'''

DICTIONARY_JSON = '{"a1": ["a2", "a3"], "a2": [], "a9": ["a1"], "a3": "oops", "a1": ["a3"]}'

PRODUCTS_CSV = '''product_id,product_name,category,subcategory,price,stock,brand,color,size,rating,reviews
p1,silk DRESS long,women,Evening wear,19.5,3,Acme,red,M,4.5,10
p2,,,,,,,,,,
,orphan,men,shirts,1.0,1,A,b,S,1.0,1
p3,"o'neil ""x"" tee",Kids,,abc,2.5,,blue,,NaN,7
'''

MASTER = {
    ("t1", "One, two", "a1", "Ann", 100.0, ("a3",)): 1,
    ("t1", "One, two", "a2", 'Bob "B" Ray', None, ()): 1,
    ("t2", "Ghost", None, None, None, None): 1,
    ("t5", "Twice", "a1", "Ann", 100.0, ("a3",)): 2,
}
MASTER_KEEP_KEY = MASTER | {("t2", "Ghost", "a9", None, None, ("a1",)): 1}
del MASTER_KEEP_KEY[("t2", "Ghost", None, None, None, None)]

PRODUCTS_CLEAN = {
    ("p1", "silk DRESS long", "women", "Evening wear", 19.5, 3, "Acme", "red", "M", 4.5, 10),
    ("p2", "Unknown", "Unknown", "Unknown", 0.0, 0, "Unknown", "Unknown", "Unknown", 0.0, 0),
    ("p3", 'o\'neil "x" tee', "Kids", "Unknown", 0.0, 0, "Unknown", "blue", "Unknown", 0.0, 7),
}
PRODUCTS_MASTER_TEXTS = {
    ("p1", "Silk Dress Long", "WOMEN", "EVENING WEAR"),
    ("p2", "Unknown", "UNKNOWN", "UNKNOWN"),
    ("p3", 'O\'neil "x" Tee', "KIDS", "UNKNOWN"),
}
